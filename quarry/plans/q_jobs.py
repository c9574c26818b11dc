"""Composite job queries: JOB1 training split text, JOB5 corpus curation, JOB7 trace filtering."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.plans import jobs as J
from quarry.plans import q_curate as QC
from quarry.plans import q_grade as QG
from quarry.plans import q_langid as QL
from quarry.plans import q_profile as QP  # noqa: F401
from quarry.plans import q_synth as QS
from quarry.plans import q_validate as QV  # noqa: F401
from quarry.plans import sqltext as S
from quarry.plans import views as V
from quarry.plans.q_text import _CHAT_T
from quarry.plans.registry import ORACLES, query
from quarry.sources import csv as CSV
from quarry.sources.scratch import scratch_path
from quarry.sources.tables import table

SEED = 42


def _size_sql(src: str, k: int, stratum: str, id_col: str, tag: str = "size") -> str:
    """Largest-remainder allocation + per-stratum rank, as CTE bodies appended to a WITH list."""
    return f""",
sc_c AS (SELECT {stratum}, count(*) AS n_c FROM {src} GROUP BY {stratum}),
sc_t AS (SELECT sum(n_c) AS n FROM sc_c),
sc_a AS (SELECT {stratum}, least({k}, n) * n_c // n AS base, (least({k}, n) * n_c) % n AS rem, least({k}, n) AS kk FROM sc_c, sc_t),
sc_b AS (SELECT {stratum}, base, kk - sum(base) OVER () AS left_, row_number() OVER (ORDER BY rem DESC, {stratum}) AS r FROM sc_a),
sc_q AS (SELECT {stratum}, base + CASE WHEN r <= left_ THEN 1 ELSE 0 END AS quota FROM sc_b),
sc_d AS (SELECT *, row_number() OVER (PARTITION BY {stratum} ORDER BY {S.hash_hex(tag, SEED, id_col)}, {id_col}) AS rn FROM {src})
"""


_CURATE_SQL = (
    QL._LANGID_SQL
    + f""", rep AS ({QC._REP}),
surv AS (SELECT d.doc_id, d.source FROM documents d JOIN rep r ON d.doc_id = r.doc_id JOIN pred p ON p.doc_id = d.doc_id
         WHERE {S.char_length('d.text')} / 4.0 <= 8192 AND r.rep_share <= 0.3 AND p.predicted = 'en')"""
    + _size_sql("surv", 100, "source", "doc_id")
    + "SELECT sc_d.doc_id, sc_d.source FROM sc_d JOIN sc_q USING (source) WHERE rn <= quota"
)


@query("curate_corpus", _CURATE_SQL)
def curate_corpus(spark, d):
    """JOB5: length budget -> repetition -> English -> 100 documents proportional per source."""
    doc = table(spark, d, "documents").select("doc_id", "text", "lang", "source")
    return J.curate_corpus(doc, 100, SEED).select("doc_id", "source")


_TRAIN_SQL = V.with_views(
    f"""SELECT id, CASE WHEN rn <= v THEN 'valid' ELSE 'train' END AS split, CASE WHEN rn > v THEN {_CHAT_T} || answer || '<|im_end|>' END AS text FROM (
  SELECT *, row_number() OVER (ORDER BY {S.hash_hex('split', SEED, 'id')}, id) AS rn,
         greatest(1, least(CAST(round_even(count(*) OVER () * 0.1, 0) AS BIGINT), count(*) OVER () - 1)) AS v
  FROM (SELECT * FROM pairs ORDER BY {S.hash_hex('sample', SEED, 'id')}, id LIMIT 200))""",
    "pairs",
)


@query("training_split_text", _TRAIN_SQL)
def training_split_text(spark, d):
    """JOB1: 200 sampled answered examples, 90/10 split, text rendered for the training rows."""
    rows = V.pairs(spark, d).select("id", "prompt", "answer")
    return J.training_split_text(rows, 200, 0.1, SEED).select("id", "split", "text")


_TRACE_SQL = V.with_views(
    f"""SELECT t.doc_id, t.trace_words FROM (
  SELECT doc_id, trace_words, w FROM (SELECT doc_id, {S.extract_tag('response', 'think')} AS trace,
       {S.extract_tag('response', 'answer')} AS answer_value, {S.word_count(S.extract_tag('response', 'think'))} AS trace_words,
       {S.words(S.extract_tag('response', 'think'))} AS w FROM traces)
  WHERE answer_value IS NOT NULL AND trace IS NOT NULL AND trace_words BETWEEN 20 AND 6000) t
JOIN batches b ON b.doc_id = t.doc_id
WHERE b.batch NOT IN (SELECT batch FROM batches GROUP BY batch HAVING avg(defect) > 0.1)
  AND (CASE WHEN len(t.w) >= 3 THEN 1 - len(list_distinct(list_transform(range(1, len(t.w) - 1), lambda i: array_to_string(t.w[i:i + 2], ' '))))
        / (len(t.w) - 2) ELSE 0.0 END) <= 0.3
  AND t.doc_id IN (SELECT problem FROM ({QG.MAJORITY_SQL}) WHERE agreement >= 0.5)""",
    "traces",
    "batches",
    "votes",
)


@query("filter_traces", _TRACE_SQL)
def filter_traces(spark, d):
    """JOB7: answer tag, trace length, trace repetition, batch rejection, samples that agree."""
    return J.filter_traces(V.traces(spark, d), V.batches(spark, d), votes=V.votes(spark, d)).select("doc_id", "trace_words")


@query("eval_set_csv", V.with_views("SELECT id, prompt, answer, category FROM eval_set", "eval_set"))
def eval_set_csv(spark, d):
    """JOB3 with its sink (SNK5): the evaluation set written as CSV and read back."""
    path = scratch_path(spark, "eval-set")
    J.write_eval_set(QS.eval_set(spark, d), path)
    return CSV.read_puzzles(spark, path).select("id", "prompt", "answer", "category")



@query("grading_report", ORACLES["error_classes"])
def grading_report(spark, d):
    """JOB2: the error classes that the grading job writes beside its predictions, read back."""
    path = scratch_path(spark, "grading")
    J.grade_generations(V.generations(spark, d), path)
    classes = spark.read.json(f"{path}/error_classes")
    return classes.select("error_class", "n")


@query("dataset_profile", " UNION ALL ".join(f"SELECT * FROM ({ORACLES[q]})" for q in ("length_profile_pairs", "word_profile", "describe_token_estimate")))
def dataset_profile(spark, d):
    """JOB4: lengths, words and token estimates described by one job."""
    p = J.profile_dataset(V.examples(spark, d))
    whole = p["lengths"].unionByName(p["words"])
    return whole.select(*[F.col(c).cast(t) for c, t in p["tokens"].dtypes]).unionByName(p["tokens"])


def _parts_sql() -> str:
    total = f"{S.char_length('prompt')} + {S.char_length('answer')}"
    hist = {"length_histogram": total, "token_histogram": f"({total}) / 4.0"}
    parts = [f"SELECT '{k}' AS part, CAST(bin AS VARCHAR) AS item, lo_edge AS x, CAST(count AS DOUBLE) AS value FROM ({QP._HIST_SQL.format(x=e, src='examples', bins=50)})" for k, e in hist.items()]
    dens = {k.replace("histogram", "density"): e for k, e in hist.items()}
    parts += [f"SELECT '{k}', CAST(point AS VARCHAR), x, density FROM ({QP._KDE_SQL.format(x=e, src='examples', grid=200)})" for k, e in dens.items()]
    words = S.words("lower(concat_ws(' ', prompt, answer))")
    parts.append(f"SELECT 'top_words', word, NULL, CAST(freq AS DOUBLE) FROM (SELECT word, count(*) AS freq FROM (SELECT unnest({words}) AS word FROM examples) GROUP BY word ORDER BY freq DESC, word LIMIT 10)")
    parts.append(f"SELECT 'short_rows', id, NULL, CAST({total} AS DOUBLE) FROM examples WHERE {total} <= 400")
    return V.with_views("SELECT * FROM (" + " UNION ALL ".join(f"SELECT * FROM ({p})" for p in parts) + ")", "examples")


@query("dataset_profile_parts", _parts_sql())
def dataset_profile_parts(spark, d):
    """JOB4, its other results: histograms and densities of length and token estimate,
    top words, and the short rows (400 characters at most here), one row per item."""
    p = J.profile_dataset(V.examples(spark, d), max_short=400)

    def part(name, item, x, value):
        return p[name].select(F.lit(name).alias("part"), F.col(item).cast("string").alias("item"), x.cast("double").alias("x"), F.col(value).cast("double").alias("value"))

    none = F.lit(None)
    out = part("top_words", "word", none, "freq").unionByName(part("short_rows", "id", none, "total_len"))
    for kind in ("length", "token"):
        out = out.unionByName(part(f"{kind}_histogram", "bin", F.col("lo_edge"), "count")).unionByName(part(f"{kind}_density", "point", F.col("x"), "density"))
    return out


@query("metrics_file", ORACLES["exact_match_accuracy"])
def metrics_file(spark, d):
    """SNK3: the metrics that the grading job writes as JSON, read back."""
    path = scratch_path(spark, "metrics")
    J.grade_generations(V.generations(spark, d), path)
    m = spark.read.json(f"{path}/eval_metrics")
    return m.select("num_rows", "raw_exact_accuracy", "normalized_exact_accuracy")


_RULES = ["v1_bits", "v2_text", "v3_numeric", "v4_numeral", "v5_symbol", "v7_answer", "v8_consistent"]


@query(
    "checking_report",
    "SELECT CAST(count(*) AS BIGINT) AS \"rows\", "
    + ", ".join(f"CAST(count(*) FILTER (WHERE NOT coalesce({c}, true)) AS BIGINT) AS {c}_failures" for c in _RULES)
    + f" FROM ({ORACLES['validate_format']}) f JOIN (SELECT id, v7_answer, v8_consistent FROM ({ORACLES['verify_consistency']})) c USING (id)",
)
def checking_report(spark, d):
    """JOB6: rule failures of the synthetic rows (the evaluation set read back from its CSV)."""
    path = scratch_path(spark, "synthetic")
    CSV.write_puzzles(QS.eval_rows(spark, d), path, extra=["category"])
    original = V.examples(spark, d).select("id", "prompt", "answer")
    report = J.check_and_augment(spark, original, f"{path}/*.csv", f"{path}-union")
    cols = ["rows", *[f"{c}_failures" for c in _RULES]]
    return spark.createDataFrame([tuple(report[c] for c in cols)], ", ".join(f"`{c}` bigint" for c in cols))


_SPLITS = V.with_views(
    f"""SELECT id, CASE WHEN rn <= v THEN 'valid' ELSE 'train' END AS split FROM (
  SELECT id, row_number() OVER (ORDER BY {S.hash_hex('split', SEED, 'id')}, id) AS rn,
         greatest(1, least(CAST(round_even(count(*) OVER () * 0.1, 0) AS BIGINT), count(*) OVER () - 1)) AS v FROM pairs)""",
    "pairs",
)


@query("prepared_splits", _SPLITS)
def prepared_splits(spark, d):
    """JOB1 without sampling: every answered example from its CSV, and the split CSVs read back."""
    path = scratch_path(spark, "prepare")
    CSV.write_puzzles(V.pairs(spark, d), f"{path}/in")
    J.prepare_training_data(spark, f"{path}/in", path, 0, 0.1, SEED)
    train, valid = (CSV.read_puzzles(spark, f"{path}/splits/{p}").select("id", F.lit(p).alias("split")) for p in ("train", "valid"))
    return train.unionByName(valid)
