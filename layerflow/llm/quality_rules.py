"""Quality rules as a short-circuit cascade, in built-in expressions only.

Each rule rejects a document on one signal. On a bounded sample, every rule is
run alone: the rows that it rejects give its selectivity, the time beyond a run
without a rule its cost. The rules are then tried in the order of rejections per
cost, and a document that one has rejected costs nothing more. The order
never changes a verdict, only what it costs.

Words are ``[^\\x20\\x09-\\x0D]+``. Repeated five-word windows are found inside the
row: equal 64-bit window hashes, compared within one document only. How many
distinct words a text has for its length is a mean over blocks of 200 words that
cover it whole, so a text is not rejected for being long.

Defined results: a null or empty text has no words, all counts 0, and fails the
least-words rule; repeated rows and rows without a doc_id are judged like any
other; an empty table gives an empty result; other columns pass through
``quality_filter`` unchanged (helper columns start with ``_q_`` and are dropped).
"""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from layerflow.llm.common import SPACE_CHARS, SPACES

SAMPLE_ROWS = 1_000       # rows on which costs and selectivities are estimated; they decide the order only
LEAST_WORDS, REPEAT_PCT = 10, 20
#: name -> signals the rule needs; what it rejects is in ``_rejects``.
SYMBOL_PCT, DUP_LINE_PCT, UPPER_PCT, EXCLAIM_PCT, ECHO_PCT, DISTINCT_PCT = 10, 50, 60, 30, 30, 20
DISTINCT_BLOCK = 200      # words of a block whose distinct words are counted


def _with_words(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds _q_t (text), _q_w (words) and _q_h (a hash of each word)."""
    docs = docs.withColumn("_q_t", F.coalesce(F.col(text), F.lit("")))
    bare = F.btrim(F.col("_q_t"), F.lit(SPACE_CHARS))
    docs = docs.withColumn("_q_w", F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, f"[{SPACES}]+")))
    return docs.withColumn("_q_h", F.transform("_q_w", lambda w: F.xxhash64(w)))


def _windows(wanted: Column) -> Column:
    h = F.col("_q_h")
    return F.when(wanted & (F.size(h) >= 5), F.transform(
        F.sequence(F.lit(0), F.size(h) - 5), lambda i: F.xxhash64(*[h[i + F.lit(k)] for k in range(5)]))
    ).otherwise(F.array().cast("array<bigint>"))


def _with_repeats(docs: DataFrame, wanted: Column | None = None) -> DataFrame:
    """Adds _q_repeat: words in five-word windows that the text has twice or more (0 where not ``wanted``)."""
    docs = docs.withColumn("_q_n", _windows(F.lit(True) if wanted is None else wanted))
    docs = docs.withColumn("_q_s", F.when(
        F.size(F.array_distinct("_q_n")) < F.size("_q_n"),
        F.sort_array(F.transform("_q_n", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))))
    s = F.col("_q_s")
    docs = docs.withColumn("_q_p", F.when(s.isNotNull(), F.sort_array(F.array_compact(F.transform(
        s, lambda x, j: F.when(F.coalesce((x["h"] == F.get(s, j - 1)["h"]) | (x["h"] == F.get(s, j + 1)["h"]),
                                          x["h"] == F.get(s, j + 1)["h"], x["h"] == F.get(s, j - 1)["h"]), x["i"]))))))
    p = F.col("_q_p")
    covered = F.aggregate(F.transform(p, lambda x, j: F.least(F.lit(5), F.coalesce(F.get(p, j + 1) - x, F.lit(5)))),
                          F.lit(0), lambda a, b: a + b)
    return docs.withColumn("_q_repeat", F.when(p.isNull(), F.lit(0)).otherwise(covered).cast("bigint"))


def _lines() -> Column:
    return F.filter(F.split(F.col("_q_t"), "\n"), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")


def _n_words() -> Column:
    return F.size("_q_w").cast("bigint")


def _word_chars() -> Column:
    return F.length(F.concat_ws("", "_q_w")).cast("bigint")


def _n_symbols() -> Column:
    return F.regexp_count("_q_t", F.lit("[#*$%&|<>]")).cast("bigint")


def _n_dup_lines() -> Column:
    lines = F.transform(_lines(), lambda line: F.xxhash64(line))
    return F.aggregate(F.array(lines), F.lit(0), lambda a, x: F.size(x) - F.size(F.array_distinct(x))).cast("bigint")


def _rejects() -> dict[str, Column]:
    """What each rule rejects, on the columns of ``_with_words`` and ``_with_repeats``."""
    words = F.size("_q_w")
    h = F.col("_q_h")
    echo = F.size(F.filter(F.sequence(F.lit(1), F.greatest(words - 1, F.lit(1))), lambda i: h[i] == h[i - 1]))
    lines = _lines()
    starts = F.sequence(F.lit(1), F.greatest(words, F.lit(1)), F.lit(DISTINCT_BLOCK))
    distinct = F.aggregate(F.transform(starts, lambda i: F.size(F.array_distinct(F.slice(h, i, DISTINCT_BLOCK)))), F.lit(0), lambda a, b: a + b)
    return {
        "few_words": words < LEAST_WORDS,
        "repeats": F.col("_q_repeat") * 100 > words * REPEAT_PCT,
        "symbols": _n_symbols() * 100 > words * SYMBOL_PCT,
        "dup_lines": _n_dup_lines() * 100 > F.size(lines) * DUP_LINE_PCT,
        "upper": F.regexp_count("_q_t", F.lit("[A-Z]")) * 100 > _word_chars() * UPPER_PCT,
        "exclaim": F.regexp_count("_q_t", F.lit("!")) * 100 > words * EXCLAIM_PCT,
        "echo": F.when(words > 1, echo * 100 > words * ECHO_PCT).otherwise(F.lit(False)),
        "few_distinct": (words >= 50) & (distinct * 100 < words * DISTINCT_PCT),
    }


def cascade_order(docs: DataFrame, text: str = "text", sample_rows: int = SAMPLE_ROWS) -> list[str]:
    """Names of the rules, those with the most rejections per second on a sample first."""
    sample = _with_words(docs.select(F.col(text).alias("text")).limit(sample_rows)).persist()
    try:
        rows = sample.count()

        def run(name: str, condition: Column) -> tuple[float, int]:
            began = time.perf_counter()
            frame = _with_repeats(sample) if name == "repeats" else sample
            got = frame.agg(F.count_if(condition)).first()[0]
            return time.perf_counter() - began, got

        idle = min(run("", F.lit(False))[0] for _ in range(2))
        gain = {}
        for name, condition in _rejects().items():
            took, rejected = run(name, condition)
            gain[name] = (rejected + 1) / (rows + 2) / max(took - idle, 1e-4)
        return sorted(gain, key=lambda k: (-gain[k], k))
    finally:
        sample.unpersist()


def _kept(order: list[str]) -> Column:
    """False at the first rule that rejects; later rules are not evaluated then."""
    rejects = _rejects()
    chain = F
    for name in order:
        chain = chain.when(rejects[name], F.lit(False))
    return F.lit(True) if chain is F else chain.otherwise(F.lit(True))


def quality_signals(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept."""
    order = order or cascade_order(docs)
    rows = _with_repeats(_with_words(docs.select("doc_id", "text")))
    rejects = _rejects()
    base = rejects["few_words"] | rejects["repeats"]
    signals = F.struct(
        "doc_id", _n_words().alias("n_words"), _word_chars().alias("word_chars"), _n_symbols().alias("n_symbols"),
        _n_dup_lines().alias("n_dup_lines"), F.col("_q_repeat").alias("n_repeat_words"), base.alias("base_failed"),
        F.when(base, F.lit(False)).otherwise(_kept([k for k in order if k not in ("few_words", "repeats")])).alias("kept"))
    # explode of one value: a filter on a signal does not work the signals out again
    return rows.select(F.explode(F.array(signals)).alias("_q_s")).select("_q_s.*")


def quality_filter(docs: DataFrame, order: list[str] | None = None) -> DataFrame:
    """The rows that no rule rejects, with their columns."""
    order = order or cascade_order(docs)
    names = docs.columns
    at = order.index("repeats")
    # window hashes are worked out only for rows that the rules ahead of theirs have left
    rows = _with_words(docs).withColumn("_q_alive", _kept(order[:at]))
    rows = _with_repeats(rows, F.col("_q_alive"))
    kept = F.when(F.col("_q_alive"), _kept(order[at:])).otherwise(F.lit(False))
    # explode of one value: the verdict is worked out once, in the projection, and not again inside the filter
    return rows.select(*names, F.explode(F.array(kept)).alias("_q_kept")).filter("_q_kept").select(*names)


SQL = rf"""
WITH w AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, array_to_string(w[i:i+4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 3)) AS i FROM w WHERE len(w) >= 5)),
d AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, g) AS c FROM g),
r AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(i, i + 5)) AS p FROM d WHERE c > 1) GROUP BY doc_id),
s AS (SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
             len(regexp_extract_all(t, '[#*$%&|<>]')) AS n_symbols,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines,
             coalesce(n, 0) AS n_repeat_words,
             len(regexp_extract_all(t, '[A-Z]')) AS upper, len(regexp_extract_all(t, '!')) AS exclaim,
             len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) AS echo, coalesce(list_sum(list_transform(range(0, len(w), {DISTINCT_BLOCK}), lambda i: len(list_distinct(w[i+1:i+{DISTINCT_BLOCK}])))), 0) AS n_distinct
      FROM w LEFT JOIN r USING (doc_id)),
b AS (SELECT *, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
             n_words < {LEAST_WORDS} OR 100 * n_repeat_words > {REPEAT_PCT} * n_words AS base_failed FROM s)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 100 * n_symbols > {SYMBOL_PCT} * n_words OR 100 * n_dup_lines > {DUP_LINE_PCT} * len(lines)
            OR 100 * upper > {UPPER_PCT} * word_chars OR 100 * exclaim > {EXCLAIM_PCT} * n_words
            OR 100 * echo > {ECHO_PCT} * n_words OR (n_words >= 50 AND 100 * n_distinct < {DISTINCT_PCT} * n_words)) AS kept
FROM b
"""
