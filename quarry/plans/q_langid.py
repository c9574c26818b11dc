"""Language identification queries (FLT9)."""

from __future__ import annotations

from quarry.operators import langid as L
from quarry.plans import sqltext as S
from quarry.plans.registry import query
from quarry.sources.tables import table

_PAD = f"(' ' || {S.collapse_ws(S.strip('lower(coalesce(text, ' + chr(39) * 2 + '))'))} || ' ')"

_LANGID_SQL = f"""
WITH t AS (SELECT doc_id, lang, {_PAD} AS t FROM documents),
occ AS (SELECT doc_id, lang, unnest(list_transform(range(1, len(c) - 1), lambda i: c[i] || c[i + 1] || c[i + 2])) AS tri
        FROM (SELECT doc_id, lang, string_split(t, '') AS c FROM t)),
m AS (SELECT lang, tri, count(*) AS c FROM occ WHERE lang IS NOT NULL
      AND {S.hex8(S.hash_hex('langfit', 42, 'doc_id'))} / 4294967296.0 * (SELECT count(lang) FROM documents) < 50000 GROUP BY lang, tri),
den AS (SELECT lang, ln(sum(c) + (SELECT count(DISTINCT tri) FROM m)) AS logden FROM m GROUP BY lang),
n AS (SELECT doc_id, greatest(length(t) - 2, 0) AS n_tri FROM t),
part AS (SELECT o.doc_id, m.lang, sum(ln(m.c + 1)) AS s FROM occ o JOIN m ON o.tri = m.tri GROUP BY o.doc_id, m.lang),
sc AS (SELECT n.doc_id, den.lang, coalesce(part.s, 0) - n.n_tri * den.logden AS score
       FROM n CROSS JOIN den LEFT JOIN part ON part.doc_id = n.doc_id AND part.lang = den.lang),
pred AS (SELECT doc_id, lang AS predicted FROM (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, lang) AS rk FROM sc) WHERE rk = 1)
"""


@query("language_id", _LANGID_SQL + "SELECT d.doc_id, d.lang, p.predicted FROM documents d JOIN pred p ON d.doc_id = p.doc_id")
def language_id(spark, d):
    """FLT9: trigram naive Bayes fitted on about 50,000 labelled documents, applied to every whole document."""
    doc = table(spark, d, "documents").select("doc_id", "text", "lang")
    return L.identify(doc, carry=["lang"])


@query("language_filter", _LANGID_SQL + "SELECT doc_id FROM pred WHERE predicted = 'en'")
def language_filter(spark, d):
    """FLT9: keep the documents identified as English."""
    doc = table(spark, d, "documents").select("doc_id", "text", "lang")
    return L.language_filter(doc, "en").select("doc_id")
