"""Quality rules: a base of simple counts, and repetition found by a suffix array over words.

For every text that has any window of 5 words twice, the suffixes of its words are put in order
(prefix doubling). The longest common prefix of a suffix with its neighbours in that order is the longest
repeated substring that starts there; the intervals of length `min_words` or more are the maximal repeats.
Their spans are united: the share of the words that long repeats cover and the longest repeat are limited.
All texts of a block are handled together in numpy; a text's suffixes are kept apart from those of others.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import _R, _TABLE, Words, _pow, flat, mix, pieces, read, ship

#: Fixed value: the characters counted as symbols.
SYMBOLS = b"#*$%&|<>"
_IS_SYMBOL = np.zeros(256, bool)
_IS_SYMBOL[list(SYMBOLS)] = True


def suffix_order(symbols: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The suffix array of several sequences that lie one after the other. symbols: of each place; end: where
    its sequence ends. Symbols of different sequences are different. Only suffixes that are still tied with
    others are sorted again at each doubling."""
    m = len(symbols)
    order = np.argsort(symbols, kind="stable")
    sorted_symbols = symbols[order]
    new = np.ones(m, bool)
    new[1:] = sorted_symbols[1:] != sorted_symbols[:-1]
    head = np.maximum.accumulate(np.where(new, np.arange(m), 0))
    rank = np.empty(m, np.int64)
    rank[order] = head
    k = 1
    place = np.arange(m)
    while True:
        size = np.diff(np.append(np.flatnonzero(new), m))
        tied = np.repeat(size > 1, size)
        if not tied.any():
            return order
        at = place[tied]  # places in the order that are still tied
        who = order[at]
        following = np.where(who + k < end[who], rank[np.minimum(who + k, m - 1)] + 1, 0)
        again = np.lexsort((following, rank[who]))
        who, following = who[again], following[again]
        order[at] = who
        group = rank[who]
        starts = np.ones(len(at), bool)
        starts[1:] = (group[1:] != group[:-1]) | (following[1:] != following[:-1])
        new[at] |= starts
        head = np.maximum.accumulate(np.where(starts, at, 0))
        rank[who] = head
        k *= 2


def common_prefix(a: np.ndarray, b: np.ndarray, total: np.ndarray, down: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Length of the longest common prefix of suffixes a and b, by halving over hashes of their prefixes."""
    most = np.minimum(end[a] - a, end[b] - b)
    got = np.zeros(len(a), np.int64)
    step = 1 << max(0, int(most.max(initial=0)).bit_length() - 1)
    while step:
        longer = got + step
        ok = longer <= most
        i, j, n = a[ok], b[ok], longer[ok]
        same = (total[i + n] - total[i]) * down[i] == (total[j + n] - total[j]) * down[j]
        got[np.flatnonzero(ok)[same]] += step
        step >>= 1
    return got


def longest_repeats(hashes: np.ndarray, first: np.ndarray, min_words: int) -> np.ndarray:
    """For each word, how many words from it on stand elsewhere in the same text too; 0 below min_words."""
    n = np.diff(first)
    out = np.zeros(len(hashes), np.int64)
    if not len(hashes):
        return out
    doc = np.repeat(np.arange(len(n)), n)
    end = np.repeat(first[1:], n)
    # Texts that have no window of min_words words twice have no repeat: their suffixes needn't be put in order
    up, down = _pow(len(hashes) + 1)
    total = np.zeros(len(hashes) + 1, np.uint64)
    np.cumsum(hashes * up[: len(hashes)], out=total[1:])
    at = np.flatnonzero(np.arange(len(hashes)) + min_words <= end)
    if not len(at):
        return out
    key = mix((total[at + min_words] - total[at]) * down[at] + doc[at].astype(np.uint64) * np.uint64(_R))
    order = np.argsort(key)
    key = key[order]
    twin = np.flatnonzero(key[1:] == key[:-1])
    if not len(twin):
        return out
    has = np.zeros(len(n), bool)
    has[doc[at[order[twin]]]] = True
    who = np.flatnonzero(has[doc])
    own_n = n[has]
    own_end = np.repeat(np.cumsum(own_n), own_n)
    symbols = np.unique(mix(hashes[who] + doc[who].astype(np.uint64) * np.uint64(_R)), return_inverse=True)[1]
    order = suffix_order(symbols, own_end)
    own_total = np.zeros(len(who) + 1, np.uint64)
    np.cumsum(hashes[who] * up[: len(who)], out=own_total[1:])
    prefix = np.zeros(len(who), np.int64)
    a, b = order[:-1], order[1:]
    near = symbols[a] == symbols[b]  # symbols are of one text each
    prefix[1:][near] = common_prefix(a[near], b[near], own_total, down, own_end)
    longest = np.zeros(len(who), np.int64)
    longest[order] = np.maximum(prefix, np.append(prefix[1:], 0))
    longest[longest < min_words] = 0
    out[who] = longest
    return out


def _per_doc(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    total = np.append(0, np.cumsum(values, dtype=np.int64))
    return total[bounds[1:]] - total[bounds[:-1]]


def covered(repeat: np.ndarray, least: int) -> np.ndarray:
    """Which words are in the united spans of repeats of so many words at least."""
    at = np.arange(len(repeat))
    return np.maximum.accumulate(at + np.where(repeat >= least, repeat, 0)) > at if len(repeat) else repeat > 0


def measure(data: np.ndarray, offsets: np.ndarray, min_words: int = 20) -> dict:
    """The counts of each text, and of each word the longest repeat from it on (0 below 5 or min_words)."""
    words = Words(data, offsets)
    hashes = words.hashes(lower=False)
    n_words = np.diff(words.first)
    starts = (data & 0xC0) != 0x80
    width = np.append(0, np.cumsum(starts))
    chars = width[words.end] - width[words.start] if len(words.start) else np.zeros(0, np.int64)
    repeat = longest_repeats(hashes, words.first, min(5, min_words))
    longest = np.zeros(len(n_words), np.int64)
    np.maximum.at(longest, words.doc[repeat > 0], repeat[repeat > 0])
    return {
        "n_words": n_words,
        "word_chars": _per_doc(chars, words.first),
        "n_symbols": _per_doc(_IS_SYMBOL[data], offsets),
        "n_dup_lines": duplicate_lines(data, offsets, words),
        "n_repeat_words": _per_doc(covered(repeat, 5), words.first),
        "n_long_words": _per_doc(covered(repeat, min_words), words.first),
        "longest_repeat": longest,
        "repeat": repeat,
        "words": words,
    }


def duplicate_lines(data: np.ndarray, offsets: np.ndarray, words: Words) -> np.ndarray:
    """Lines with a word that equal an earlier line of the text."""
    out = np.zeros(len(offsets) - 1, np.int64)
    if not len(words.start):
        return out
    breaks = np.flatnonzero(data == 10)
    # A line starts at a text's start and after each break, and ends before a break or at the text's end
    start = np.unique(np.concatenate([offsets[:-1], breaks + 1]))
    start = start[start < len(data)]
    stop = np.append(start[1:], len(data))
    stop = np.where((stop > start) & (data[stop - 1] == 10), stop - 1, stop)
    has = np.searchsorted(words.start, stop) > np.searchsorted(words.start, start)
    start, stop = start[has], stop[has]
    up, down = _pow(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_TABLE[data] * up[: len(data)], out=total[1:])
    doc = np.searchsorted(offsets, start, side="right") - 1
    key = mix((total[stop] - total[start]) * down[start] + doc.astype(np.uint64) * np.uint64(_R))
    order = np.argsort(key, kind="stable")
    twin = order[1:][key[order][1:] == key[order][:-1]]
    np.add.at(out, doc[twin], 1)
    return out


SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, longest_repeat long, n_long_words long"


def apply_rules(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = 20,
    max_percent: int = 10,
    max_longest: int = 100,
    spans: bool = False,
    carry: bool = False,
) -> DataFrame:
    """Counts and verdict of every whole text; with spans=True also the maximal repeats as (start, end) in words; with
    carry=True only kept, after all columns of docs.

    The base fails a text of under 10 words, or with over 20 % of its words in 5-word windows that stand in it
    twice or more. The suffix-array rules fail one whose united repeats of `min_words` words or more cover over
    `max_percent` of its words, or whose longest repeat is over `max_longest` words. No shuffle; blocks of about
    1 MB of text. Defined results: a null or empty text has no words and fails the base; a very long text is one block;
    a text exactly at a limit is kept; a text of one line has no duplicate lines; rows that repeat are judged one by one; other
    columns are ignored (with carry=True they must not be named kept); an empty table gives no rows.
    """
    ship(docs.sparkSession)

    def run(batches):
        for batch in batches:
            keys, texts = batch.column(id_col if carry else "doc_id"), batch.column(text_col if carry else "text")
            for a, b in pieces(texts):
                m = measure(*flat(texts.slice(a, b - a)), min_words)
                failed = (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])
                kept = ~failed & (100 * m["n_long_words"] <= max_percent * m["n_words"]) & (m["longest_repeat"] <= max_longest)
                if carry:
                    yield pa.RecordBatch.from_arrays([*batch.slice(a, b - a).columns, pa.array(kept)], [*batch.schema.names, "kept"])
                    continue
                columns = [keys.slice(a, b - a).cast(pa.int64())]
                columns += [pa.array(m[c].astype(np.int64)) for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines")]
                columns += [pa.array(m["n_repeat_words"].astype(np.int64)), pa.array(failed), pa.array(kept), pa.array(m["longest_repeat"]), pa.array(m["n_long_words"].astype(np.int64))]
                names = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "longest_repeat", "n_long_words"]
                if spans:
                    columns.append(maximal_spans(np.where(m["repeat"] >= min_words, m["repeat"], 0), m["words"].first))
                    names.append("repeats")
                yield pa.RecordBatch.from_arrays(columns, names)

    if carry:
        return docs.mapInArrow(run, T.StructType([*docs.schema, T.StructField("kept", T.BooleanType())]))
    schema = SCHEMA + ", repeats array<struct<start: int, end: int>>" * spans
    return docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).mapInArrow(run, schema)


def maximal_spans(repeat: np.ndarray, first: np.ndarray) -> pa.Array:
    """Per text the repeats that can't be made longer to the left, as word places."""
    at = np.arange(len(repeat))
    inner = np.zeros(len(repeat), bool)
    inner[1:] = repeat[:-1] == repeat[1:] + 1
    inner[first[:-1][first[:-1] < len(repeat)]] = False
    starts = np.flatnonzero((repeat > 0) & ~inner)
    doc = np.searchsorted(first, starts, side="right") - 1
    rows: list[list] = [[] for _ in range(len(first) - 1)]
    for s, d in zip(at[starts], doc, strict=True):
        rows[d].append({"start": int(s - first[d]), "end": int(s - first[d] + repeat[s])})
    return pa.array(rows, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))


def op5_quality_rules(spark, sf_dir: str) -> DataFrame:
    return apply_rules(read(spark, sf_dir, "documents")).drop("longest_repeat")


OP5_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
five AS (SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
hit AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM five) WHERE n > 1),
cov AS (SELECT r, sum(least(5, nxt - i)) AS covered FROM (SELECT r, i, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i), i + 5) AS nxt FROM hit) GROUP BY r),
twenty AS (SELECT h.r, h.i, array_to_string(w[h.i:h.i + 19], ' ') AS g FROM hit h JOIN d ON d.r = h.r WHERE h.i + 19 <= len(w)),
hit20 AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM twenty) WHERE n > 1),
cov20 AS (SELECT r, sum(least(20, nxt - i)) AS covered20 FROM (SELECT r, i, coalesce(lead(i) OVER (PARTITION BY r ORDER BY i), i + 20) AS nxt FROM hit20) GROUP BY r),
long AS (
  SELECT DISTINCT r FROM (
    SELECT h.r, array_to_string(w[h.i:h.i + 100], ' ') AS g FROM hit h JOIN d ON d.r = h.r WHERE h.i + 100 <= len(w))
  GROUP BY r, g HAVING count(*) > 1),
m AS (
  SELECT d.r, doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    (length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')))::BIGINT AS n_symbols,
    len(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')))::BIGINT
      - len(list_distinct(list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]'))))::BIGINT AS n_dup_lines,
    coalesce(covered, 0)::BIGINT AS n_repeat_words, coalesce(covered20, 0)::BIGINT AS n_long_words, long.r IS NOT NULL AS too_long
  FROM d LEFT JOIN cov ON cov.r = d.r LEFT JOIN cov20 ON cov20.r = d.r LEFT JOIN long ON long.r = d.r)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
  (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
  NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND NOT too_long AND 100 * n_long_words <= 10 * n_words AS kept, n_long_words
FROM m
"""
