"""quarry: prompt/answer and corpus preparation as Spark DataFrame jobs.

Sub-packages:
  functions  column expressions (text, hashing, numbers, NFKC)
  sources    CSV / JSON / text sources and sinks, driver tables
  operators  profiling, sampling, curation, validation, synthesis, grading, tokenizer
  plans      fixture views, registered queries and their DuckDB oracles, jobs
  streaming  the stateless curation expressions on a streaming DataFrame
"""

__all__ = ["functions", "sources", "operators", "plans", "streaming"]
