"""Spelling variants of the vocabulary of a corpus: words one edit apart, joined over sorted lists.

Words are counted in one aggregate (partial sums per task); only the vocabulary moves after that.  Two words one
edit apart share everything before and after the edit, so they meet in a window: the words that agree in their
first ``lo`` and last ``hi`` code points and whose edit lies between.  A window is halved by the place of the edit
(left or right of the middle of the shorter word); after the first halving, windows of more than ``most`` words
are halved again until none is left, so that no task holds a list that grows with the vocabulary.  A pair belongs to the
one window that holds the first place where the words differ.

Within a window the list is sorted and scanned for each word from its own place on: the rows of the edit matrix,
three cells wide, are kept up to the prefix that neighbours of the list share (LCP) and computed anew only
beyond it; once a prefix costs more than one edit, all words that share it are skipped.

Per window and word a task returns the number of near words and the best of them, never the pairs.  Forms have at
least ``ratio`` times the count of their word, so chains are short; roots are found by following forms from both ends
(each round doubles the distance), on the words that have a form.

Defined results: null and empty texts have no words; a null id is written as nothing before the colon; rows that
repeat count as often as they occur; the empty table gives the empty table.  Other columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.llm.common import partitions, stored
from labelkiln.session import ship_package

LEAST_LENGTH, LEAST_COUNT, RATIO, NOISE = 6, 5, 5, 199
#: Above the number of words that can differ in one place only, so halving always ends.
MOST_WORDS = 10_000
LETTERS = "a-zÀ-ÿ"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_FAR = 2


def noisy_words(docs: DataFrame, id_col: str, text_col: str, least_length: int, noise: int) -> DataFrame:
    """``word`` of every run of letters of at least ``least_length`` code points after a hash of id and run has
    decided whether the run loses one code point."""
    lowered = F.translate(F.col(text_col).cast("string"), _UPPER, _UPPER.lower())
    runs = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(lowered, F.lit(f"[{LETTERS}]{{{least_length},}}"), F.lit(0))).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.expr("left(run, cast(h % length(run) as int))"), F.substring(F.col("run"), at + 2, F.length("run")))
    runs = runs.select("run", h.alias("h"))
    return runs.select(F.when(F.col("h") % noise == 0, cut).otherwise(F.col("run")).alias("word"))


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least_length: int = LEAST_LENGTH,
               least_count: int = LEAST_COUNT, noise: int = NOISE) -> DataFrame:
    """``word, n``, stored."""
    words = noisy_words(docs, id_col, text_col, least_length, noise).filter(F.length("word") >= least_length)
    return stored(words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count), "vocabulary")


def _window(m: Column, lo: Column, hi: Column) -> Column:
    """The window of words whose shorter partner has ``m`` code points: equal keys, equal ends."""
    word = F.col("word")
    return F.concat_ws(" ", m.cast("string"), lo.cast("string"), hi.cast("string"),
                       F.substring(word, F.lit(1), lo), F.expr("right(word, hi)"))


def _halved(rows: DataFrame) -> DataFrame:
    """Each window cut at the middle of what may differ: the edit lies right of it, or left of it."""
    half = F.floor((F.col("m") - F.col("lo") - F.col("hi")) / 2).cast("int")
    right = F.struct((F.col("lo") + half).alias("lo"), F.col("hi").alias("hi"))
    left = F.struct(F.col("lo").alias("lo"), (F.col("m") - F.col("lo") - half).cast("int").alias("hi"))
    # nothing can differ left of a middle that is the window's own start
    sides = F.when(half > 0, F.array(right, left)).otherwise(F.array(right))
    return rows.withColumn("side", F.explode(sides)).select("word", "n", "m", "side.lo", "side.hi")


def windows(words: DataFrame, most: int = MOST_WORDS, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word, n, m, lo, hi, key`` with at most ``most`` words a key (or what differs in one place)."""
    length = F.length("word")
    whole = words.withColumn("m", F.explode(F.when(length > least_length, F.array(length, length - 1)).otherwise(
        F.array(length)))).withColumns({"lo": F.lit(0), "hi": F.lit(0)})
    rows, done, turn = _halved(whole), None, 0
    while True:
        rows = stored(rows.withColumn("key", _window(F.col("m"), F.col("lo"), F.col("hi"))), f"windows{turn}")
        large = stored(rows.groupBy("key").agg(F.count("*").alias("size"), F.max(F.col("m") - F.col("lo") - F.col("hi"))
                       .alias("open")).filter((F.col("size") > most) & (F.col("open") > 1)).select("key"), "large-windows")
        if large.isEmpty():
            return rows if done is None else done.unionByName(rows)
        small = rows.join(large, "key", "left_anti").select("word", "n", "m", "lo", "hi", "key")
        done = small if done is None else done.unionByName(small)
        rows, turn = _halved(rows.join(large, "key", "left_semi")), turn + 1


def shared_prefix(a: str, b: str) -> int:
    k = 0
    for x, y in zip(a, b, strict=False):
        if x != y:
            break
        k += 1
    return k


def near_pairs(words: Sequence[str], lcp: Sequence[int]) -> Iterator[tuple[int, int]]:
    """Index pairs (i < j) one edit apart within a sorted list of distinct words; ``lcp[j]`` is the prefix that words
    j - 1 and j share.

    A row holds the cells left of, on and right of the diagonal: the edits between the first d code points of
    the other word and the first d - 1, d and d + 1 of this one.
    """
    n = len(words)
    for i in range(n):
        q = words[i]
        m = len(q)
        rows, j = [(_FAR, 0, 1)], i + 1
        # the neighbour starts with what it shares with the word itself, at no cost
        rows += [(1, 0, 1)] * (lcp[j] if j < n else 0)
        while j < n:
            c = words[j]
            d = len(rows) - 1
            alive = True
            while d < len(c):
                left, here, right = rows[d]
                x = c[d]
                # d + 1 code points of c against d, d + 1 and d + 2 of q
                new_left = min(left + (d < 1 or d > m or q[d - 1] != x), here + 1) if d <= m else _FAR
                new_here = min(here + (q[d] != x), right + 1, new_left + 1) if d < m else _FAR
                new_right = min(right + (q[d + 1] != x), new_here + 1) if d + 1 < m else _FAR
                d += 1
                rows.append((new_left, new_here, new_right))
                if new_left > 1 and new_here > 1 and new_right > 1:
                    alive = False
                    break
            if alive and -1 <= m - d <= 1 and rows[d][m - d + 1] == 1:
                yield i, j
            if alive:
                j += 1
            else:
                # every word that starts like c up to here is out of reach
                j = bisect_left(words, c[:d] + "\U0010ffff", j + 1) if j + 1 < n and lcp[j + 1] >= d else j + 1
            if j < n:
                keep = shared_prefix(c, words[j]) if not alive else lcp[j]
                del rows[keep + 1 :]


def window_matches(m: int, lo: int, hi: int, words: list[str], counts: list[int]) -> list[tuple[str, int, int, str]]:
    """``(word, near words, n of the best, the best)`` for the words of one window that have near words."""
    inner = sorted(((w[lo : len(w) - hi], w, n) for w, n in zip(words, counts, strict=True)))
    middles = [x[0] for x in inner]
    lcp = [0] + [shared_prefix(a, b) for a, b in zip(middles, middles[1:], strict=False)]
    found: dict[int, list] = {}
    for i, j in near_pairs(middles, lcp):
        a, b = inner[i][1], inner[j][1]
        if min(len(a), len(b)) != m:
            continue
        at = min(shared_prefix(a, b), m)
        if at < lo or (hi and at >= m - hi):
            continue
        for x, y in ((i, j), (j, i)):
            rank = (-inner[y][2], inner[y][1])
            mine = found.setdefault(x, [0, rank])
            mine[0] += 1
            mine[1] = min(mine[1], rank)
    return [(inner[x][1], k, -best[0], best[1]) for x, (k, best) in found.items()]


def near_words(words: DataFrame, most: int = MOST_WORDS, least_length: int = LEAST_LENGTH) -> DataFrame:
    """``word, n_near, best, best_n`` for the words that have near words."""
    spark = words.sparkSession
    ship_package(spark)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = ["word", "n_near", "best_n", "best"]
        key, head, held, counts, out = None, None, [], [], []
        for b in batches:
            for k, w, n, m, lo, hi in zip(b["key"], b["word"], b["n"], b["m"], b["lo"], b["hi"], strict=True):
                if k != key:
                    if len(held) > 1:
                        out += window_matches(*head, held, counts)
                    key, head, held, counts = k, (m, lo, hi), [], []
                held.append(w)
                counts.append(n)
            if len(out) > 10_000:
                yield pd.DataFrame(out, columns=names)
                out = []
        if len(held) > 1:
            out += window_matches(*head, held, counts)
        if out:
            yield pd.DataFrame(out, columns=names)

    rows = windows(words, most, least_length)
    found = (rows.repartition(partitions(spark), "key").sortWithinPartitions("key")
             .mapInPandas(scan, "word string, n_near long, best_n long, best string"))
    best = F.min(F.struct((-F.col("best_n")).alias("order"), "best"))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("top")).select(
        "word", "n_near", F.col("top.best").alias("best"), (-F.col("top.order")).alias("best_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` from ``word, form`` (both not null, without cycles): every round doubles the way followed."""
    links, turn = stored(forms.select("word", F.col("form").alias("root")), "roots0"), 0
    while True:
        ahead = links.select(F.col("word").alias("root"), F.col("root").alias("next"))
        more = links.join(ahead, "root", "left")
        turn += 1
        links = stored(more.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")),
                       f"roots{turn}")
        if links.filter("moved").isEmpty():
            return links.select("word", "root")
        links = links.select("word", "root")


def variant_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", ratio: int = RATIO,
                   most: int = MOST_WORDS) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of the vocabulary."""
    words = vocabulary(docs, id_col, text_col)
    near = near_words(words, most)
    is_form = F.col("best_n") >= F.col("n") * ratio
    told = stored(words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n")), "forms")
    ends = roots(told.filter("form IS NOT NULL"))
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
