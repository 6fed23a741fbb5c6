"""Quality rules kept as a ledger of failure bits and measurements.

Every rule is evaluated once per document. Its outcome is one bit of ``failed`` and what it looked at stays in the
ledger, so a new policy or an ablation reads the ledger alone and never the texts again. A policy is a named set of
rules; a document passes it if no bit of the set is on.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablewright.llm.base import WORDS, struct_array, texts, worker_cache

SYMBOLS = "#*$%&|<>"
BULLETS = ("-", "*", "•", "‣", "–")
MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_letter_words", "n_bullet_lines", "n_ellipsis_lines")
_KIND = pa.struct([(m, pa.int64()) for m in MEASURES])

#: Rule name -> when it fails, on the ledger's struct, in whole numbers. The place here is the bit; add new rules at the end.
RULES = {
    "few_words": lambda m: m["n_words"] < 50,
    "repeated_windows": lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"],
    "short_words": lambda m: m["word_chars"] < 3 * m["n_words"],
    "long_words": lambda m: m["word_chars"] > 12 * m["n_words"],
    "symbols": lambda m: 10 * m["n_symbols"] > m["n_words"],
    "repeated_lines": lambda m: 2 * m["n_dup_lines"] > m["n_lines"],
    "few_letter_words": lambda m: 10 * m["n_letter_words"] < 7 * m["n_words"],
    "bullet_lines": lambda m: (m["n_lines"] >= 10) & (10 * m["n_bullet_lines"] > 9 * m["n_lines"]),
    "ellipsis_lines": lambda m: (m["n_lines"] >= 10) & (10 * m["n_ellipsis_lines"] > 3 * m["n_lines"]),
}
BITS = {name: 1 << i for i, name in enumerate(RULES)}
#: Version -> rules that reject a document.
POLICIES = {
    "base": ("few_words", "repeated_windows"),
    "v1": ("few_words", "repeated_windows", "symbols", "few_letter_words"),
    "v2": tuple(RULES),
}
CURRENT = "v2"


def mask(policy: str | tuple[str, ...]) -> int:
    """The bits of a policy, given by version or as rule names."""
    return sum({BITS[r] for r in (POLICIES[policy] if isinstance(policy, str) else policy)})


def repeat_words(words: list[str], size: int = 3) -> int:
    """Words that lie in a window of ``size`` words found twice or more, the first occurrence included."""
    n = len(words) - size + 1
    if n < 2:
        return 0
    known: dict[str, int] = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    if len(known) == len(words):
        return 0
    windows = ids[:n]
    for k in range(1, size):  # numbers of windows stay small: at most one per word
        _, windows = np.unique(windows * len(known) + ids[k : k + n], return_inverse=True)
    hits = np.bincount(windows)[windows] > 1
    marks = np.zeros(len(words) + 1, np.int64)
    at = np.flatnonzero(hits)
    np.add.at(marks, at, 1)
    np.add.at(marks, at + size, -1)
    return int(np.count_nonzero(np.cumsum(marks[:-1]) > 0))


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one text, in the order of MEASURES; all 0 without text."""
    if not text:
        return (0,) * len(MEASURES)
    words = WORDS.findall(text)
    seen: set[str] = set()
    lines = repeated = bullets = ellipses = 0
    for line in text.split("\n"):
        bare = line.strip("\x20\t\n\v\f\r")
        if not bare:
            continue
        lines += 1
        repeated += line in seen
        seen.add(line)
        bullets += bare.startswith(BULLETS)
        ellipses += bare.endswith(("...", "…"))
    letters = sum(1 for w in words if w.isalpha() or any(map(str.isalpha, w)))
    return len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), lines, repeated, repeat_words(words), letters, bullets, ellipses


def _measured(column: pa.Array) -> pa.Array:
    worker_cache("quality", dict)  # nothing is kept, and nothing of other operators
    return struct_array([measure(t) for t in texts(column)], _KIND)


def with_ledger(df: DataFrame, text: str = "text", name: str = "ledger") -> DataFrame:
    """``df`` with a struct of all measurements and ``failed``, the bits of the rules that the text breaks.

    Null and empty texts have no words and break what that breaks. Repeated rows stay. A column called ``name`` is replaced.
    """
    kind = "struct<" + ",".join(f"{m}:long" for m in MEASURES) + ">"
    measured = F.arrow_udf(_measured, kind).asNondeterministic()  # so that it runs once, however often it is read
    held = df.withColumn(name, measured(F.col(text)))
    bits = [F.when(fails(F.col(name)), F.lit(BITS[rule])).otherwise(0) for rule, fails in RULES.items()]
    return held.withColumn(name, F.col(name).withField("failed", sum(bits[1:], bits[0]).cast("long")))


def broken(policy: str | tuple[str, ...] = CURRENT, name: str = "ledger") -> Column:
    """Whether the policy rejects the document, from the ledger alone."""
    return F.col(name)["failed"].bitwiseAND(F.lit(mask(policy))) != 0


def ablation(df: DataFrame, policy: str | tuple[str, ...] = CURRENT, name: str = "ledger") -> DataFrame:
    """What each rule of a policy does: documents that break it, that break it alone, and that are kept without it.

    The ledger is counted by pattern of failure bits (at most one row per pattern and task is shuffled); everything
    else is bit arithmetic on the patterns. One row per rule, also over an empty ledger.
    """
    within = mask(policy)
    patterns = df.groupBy(F.col(name)["failed"].bitwiseAND(F.lit(within)).alias("bits")).agg(F.count("*").alias("n"))
    names = [r for r in RULES if BITS[r] & within]
    at = F.coalesce(F.sum(F.col("n")), F.lit(0))
    held = [
        F.struct(
            F.lit(r).alias("rule"),
            F.lit(BITS[r]).cast("long").alias("bit"),
            F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.lit(BITS[r])) != 0, F.col("n"))), F.lit(0)).alias("n_broken"),
            F.coalesce(F.sum(F.when(F.col("bits") == BITS[r], F.col("n"))), F.lit(0)).alias("n_alone"),
            F.coalesce(F.sum(F.when(F.col("bits").bitwiseAND(F.lit(within & ~BITS[r])) == 0, F.col("n"))), F.lit(0)).alias("n_kept_without"),
            at.alias("n_documents"),
        )
        for r in names
    ]
    return patterns.agg(F.array(*held).alias("x")).select(F.inline("x"))


#: The query over `documents` in DuckDB's SQL.
ORACLE = r"""
WITH t AS (
  SELECT doc_id, coalesce(text, '') AS x, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda s: regexp_matches(s, '[^\x20\x09-\x0D]')) AS l
  FROM documents),
g AS (
  SELECT *, CASE WHEN len(w) < 3 THEN [] ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || chr(10) || w[i + 1] || chr(10) || w[i + 2]) END AS g FROM t),
c AS (SELECT *, row_number() OVER () AS rid FROM g),
e AS (SELECT rid, unnest(g) AS gram, generate_subscripts(g, 1) AS i FROM c),
d AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM e),
r AS (SELECT rid, count(DISTINCT k) AS n_repeat_words FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS k FROM d WHERE n > 1) GROUP BY rid),
m AS (
  SELECT doc_id, len(w) AS n_words, coalesce(list_sum(list_transform(w, lambda s: length(s))), 0)::BIGINT AS word_chars,
    length(x) - length(regexp_replace(x, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words, len(list_filter(w, lambda s: regexp_matches(s, '\pL'))) AS n_letter,
    len(list_filter(l, lambda s: regexp_matches(s, '^[\x20\x09-\x0D]*[-*•‣–]'))) AS n_bullet, len(list_filter(l, lambda s: regexp_matches(s, '(\.\.\.|…)[\x20\x09-\x0D]*$'))) AS n_dots
  FROM c LEFT JOIN r USING (rid)),
b AS (
  SELECT *, (n_words < 50)::BIGINT + 2 * (100 * n_repeat_words > 50 * n_words)::BIGINT + 4 * (word_chars < 3 * n_words)::BIGINT + 8 * (word_chars > 12 * n_words)::BIGINT
    + 16 * (10 * n_symbols > n_words)::BIGINT + 32 * (2 * n_dup_lines > n_lines)::BIGINT + 64 * (10 * n_letter < 7 * n_words)::BIGINT
    + 128 * (n_lines >= 10 AND 10 * n_bullet > 9 * n_lines)::BIGINT + 256 * (n_lines >= 10 AND 10 * n_dots > 3 * n_lines)::BIGINT AS failed_bits
  FROM m)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars, n_symbols::BIGINT AS n_symbols, n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words,
  failed_bits & 3 != 0 AS base_failed, failed_bits = 0 AS kept, failed_bits
FROM b
"""
