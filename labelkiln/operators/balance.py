"""Class weights, deficits, sampling, rebalancing and augmentation.

Per-class numbers come from one grouped count (bounded by the vocabulary) joined back by label.
"Random" choices are seeded md5 hashes of (id, position, seed), so results repeat on any
partitioning and equal the DuckDB twins.  Per-class caps use the skew-safe exact rank
(:func:`labelkiln.operators.ranking.rank_within`).
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.operators.ranking import hash_order, hash_unit, rank_within

MASK = "[MASK]"


def class_weights(df: DataFrame, label: str = "label", manual: Mapping[str, float] | None = None) -> DataFrame:
    """Balanced weights ``N / (k * n_j)``, or weights given by hand."""
    c = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").cast("bigint").alias("n"))
    if manual:
        m = F.create_map(*[x for k, v in manual.items() for x in (F.lit(k), F.lit(float(v)))])
        return c.withColumn("weight", F.element_at(m, F.col(label)))
    n_all = c.agg(F.sum("n")).scalar()
    k = c.agg(F.count("*")).scalar()
    return c.withColumn("weight", n_all / (k * F.col("n")))


def with_weights(df: DataFrame, weights: DataFrame, label: str = "label", out: str = "weight") -> DataFrame:
    """Attach class weights to rows (the weight table is bounded by the vocabulary: broadcast)."""
    # a join by class would send all rows of a class to one task
    return df.join(F.broadcast(weights.select(label, F.col("weight").alias(out))), label, "left")


def pos_weights(df: DataFrame, labels: str = "labels") -> DataFrame:
    """Per label ``neg / pos`` for a multi-label loss (``labels`` is an array column)."""
    n = df.agg(F.count("*")).scalar()
    c = (df.select(F.explode(F.array_distinct(labels)).alias("label")).groupBy("label")
         .agg(F.count("*").cast("bigint").alias("pos")))
    return c.withColumn("neg", (n - F.col("pos")).cast("bigint")).withColumn("pos_weight", F.col("neg") / F.col("pos"))


def deficits(df: DataFrame, label: str = "label", target: int = 100) -> DataFrame:
    """Per class ``n``, ``deficit = max(target - n, 0)`` and variants per text
    ``ceil(deficit / n)`` (H14)."""
    c = df.filter(F.col(label).isNotNull()).groupBy(label).agg(F.count("*").cast("bigint").alias("n"))
    d = F.greatest(F.lit(target) - F.col("n"), F.lit(0)).cast("bigint")
    return c.withColumn("deficit", d).withColumn("variants", F.ceil(F.col("deficit") / F.col("n")).cast("bigint"))


def balanced_sample(df: DataFrame, label: str = "label", n: int = 30000, seed: int = 42,
                    id_col: str = "id") -> DataFrame:
    """the first ``n`` rows of every class in seeded hash order (all of a smaller class)."""
    r = rank_within(df.filter(F.col(label).isNotNull()), [label], hash_order(id_col, seed), out="__p")
    return r.filter(F.col("__p") < n).drop("__p")


def rebalance(df: DataFrame, label: str = "label", target: int = 100, seed: int = 42,
              id_col: str = "id") -> DataFrame:
    """every class to exactly ``target`` rows: frequent classes keep their first ``target`` rows
    in hash order, rare classes are repeated (``copy`` 0, 1, ...) in that order up to ``target``.
    Row ``i`` of the output for a class of size ``n`` is the row at position ``i mod n``; copies are
    produced by ``explode(sequence)`` per row, so nothing is collected per class."""
    src = df.filter(F.col(label).isNotNull())
    r = rank_within(src, [label], hash_order(id_col, seed), out="__p", size_col="__n")
    copies = F.ceil(F.lit(target) / F.col("__n")).cast("int")
    r = r.withColumn("copy", F.explode(F.sequence(F.lit(0), copies - 1)))
    return r.filter(F.col("copy") * F.col("__n") + F.col("__p") < target).drop("__p", "__n")


# ---------------------------------------------------------------------------------------------
# augmentation on word arrays (M1-M5); ``words`` is an array<string> column


def split_words(text: str | Column) -> Column:
    c = F.col(text) if isinstance(text, str) else text
    return F.filter(F.split(F.trim(c), r"\s+"), lambda x: x != "")


def eda_delete(words: Column, id_col: str | Column, p: float = 0.1, seed: int = 42) -> Column:
    """M4: drop each word with probability ``p`` (seeded per id and position); an all-deleted text
    keeps its first word."""
    kept = F.filter(words, lambda w, i: hash_unit(id_col, i, seed=seed) >= p)
    return F.when(F.size(kept) > 0, kept).otherwise(F.slice(words, 1, 1))


def swap_positions(words: Column, id_col: str | Column, seed: int = 42) -> tuple[Column, Column]:
    """Two seeded 0-based positions of a word array (compute once per row, outside any lambda)."""
    n = F.size(words)
    i1 = F.floor(hash_unit(id_col, F.lit("s1"), seed=seed) * n).cast("int")
    i2 = F.floor(hash_unit(id_col, F.lit("s2"), seed=seed) * n).cast("int")
    return i1, i2


def eda_swap(words: Column, i1: Column, i2: Column) -> Column:
    """M3: swap the words at positions ``i1`` and ``i2``.  ``words``, ``i1`` and ``i2`` should be
    column references (see :func:`eda_swap_df`) so they are evaluated once per row, not per word."""
    return F.when(F.size(words) < 2, words).otherwise(F.transform(
        words, lambda w, i: F.when(i == i1, F.element_at(words, i2 + 1))
        .when(i == i2, F.element_at(words, i1 + 1)).otherwise(w)))


def eda_swap_df(df: DataFrame, text: str = "text", id_col: str = "id", seed: int = 42,
                out: str = "augmented") -> DataFrame:
    """M3 on a table: split once, pick two seeded positions once, swap."""
    d = df.withColumn("__w", split_words(text))
    i1, i2 = swap_positions(F.col("__w"), id_col, seed)
    d = d.withColumn("__i1", i1).withColumn("__i2", i2)
    return d.withColumn(out, F.array_join(eda_swap(F.col("__w"), F.col("__i1"), F.col("__i2")), " ")).drop(
        "__w", "__i1", "__i2")


def mask_words(words: Column, id_col: str | Column, p: float = 0.15, seed: int = 42) -> Column:
    """M5: replace each word by ``[MASK]`` with probability ``p``."""
    return F.transform(words, lambda w, i: F.when(hash_unit(id_col, i, F.lit("m"), seed=seed) < p,
                                                  F.lit(MASK)).otherwise(w))


def choose_synonym(synonyms: DataFrame, seed: int = 42) -> DataFrame:
    """One synonym per word: the one first in seeded hash order (``word, synonym``; lower case)."""
    s = synonyms.select(F.lower("word").alias("word"), F.col("synonym"))
    s = s.withColumn("__h", F.md5(F.concat_ws(":", "word", "synonym", F.lit(str(seed)))))
    return s.groupBy("word").agg(F.min_by("synonym", "__h").alias("synonym"))


def eda_synonym(df: DataFrame, synonyms: DataFrame, text: str = "text", id_col: str = "id",
                p: float = 0.2, seed: int = 42, stop_words: Sequence[str] = (), out: str = "augmented") -> DataFrame:
    """M1: replace words (not stop words) that have a synonym, each with probability ``p``.

    The draw and the stop words are applied before the join, so only the drawn share of the words is
    exploded and joined to the one-synonym-per-word table; the hits of a row come back as one map and
    the text is patched in place.  Rows are told apart by id and text; a blank text stays blank, a NULL
    text gives NULL."""
    stop_list = [w.lower() for w in stop_words]
    d = df.withColumn("__w", split_words(text)).withColumn(
        "__key", F.concat_ws(":", F.col(id_col).cast("string"), F.md5(F.col(text))))
    w = d.filter(F.col(text).isNotNull()).select("__key", id_col, F.posexplode("__w").alias("pos", "w"))
    w = w.filter(hash_unit(id_col, "pos", F.lit("r"), seed=seed) < p).select("__key", "pos", F.lower("w").alias("word"))
    if stop_list:
        w = w.filter(~F.col("word").isin(stop_list))
    hits = (w.join(choose_synonym(synonyms, seed), "word").groupBy("__key")
            .agg(F.map_from_entries(F.collect_set(F.struct("pos", "synonym"))).alias("__hits")))
    patched = F.when(F.col("__hits").isNull(), F.col("__w")).otherwise(F.transform(
        "__w", lambda x, i: F.coalesce(F.try_element_at("__hits", i), x)))
    return (d.join(hits, "__key", "left")
            .withColumn(out, F.when(F.col(text).isNotNull(), F.array_join(patched, " ")))
            .drop("__w", "__key", "__hits"))


def eda_insert(df: DataFrame, synonyms: DataFrame, text: str = "text", id_col: str = "id", seed: int = 42,
               out: str = "augmented") -> DataFrame:
    """M2: insert a synonym of one seeded word at a seeded position (no explode: one lookup per row)."""
    syn = choose_synonym(synonyms, seed)
    words = split_words(text)
    n = F.size(words)
    pick = F.element_at(words, (F.floor(hash_unit(id_col, F.lit("i1"), seed=seed) * n) + 1).cast("int"))
    d = df.withColumn("__w", F.when(n > 0, F.lower(pick)))
    d = d.join(syn.withColumnRenamed("word", "__w"), "__w", "left")
    at = (F.floor(hash_unit(id_col, F.lit("i2"), seed=seed) * (n + 1)) + 1).cast("int")
    ins = F.when(F.col("synonym").isNotNull(), F.array_insert(words, at, F.col("synonym"))).otherwise(words)
    return d.withColumn(out, F.array_join(ins, " ")).drop("__w", "synonym")


def default_augment(df: DataFrame, text: str = "text", id_col: str = "id", variant: str = "variant_no",
                    seed: int = 42) -> DataFrame:
    """Built-in augmenter for :func:`augment_to_target`: variant v of a text is an EDA deletion (odd v)
    or swap (even v), seeded by (id, v).  Words and swap positions are computed once per row."""
    key = F.concat_ws(":", F.col(id_col).cast("string"), F.col(variant).cast("string"))
    d = df.withColumn("__w", split_words(text)).withColumn("__k", key)
    i1, i2 = swap_positions(F.col("__w"), F.col("__k"), seed)
    d = d.withColumn("__i1", i1).withColumn("__i2", i2)
    new = F.when(F.col(variant) % 2 == 1, eda_delete(F.col("__w"), F.col("__k"), 0.1, seed)).otherwise(
        eda_swap(F.col("__w"), F.col("__i1"), F.col("__i2")))
    return d.withColumn(text, F.array_join(new, " ")).drop("__w", "__k", "__i1", "__i2")


def augment_to_target(df: DataFrame, label: str = "label", target: int = 100, text: str = "text",
                      id_col: str = "id", seed: int = 42,
                      augmenter: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """M6: fill each rare class up to ``target``: every text of a class with deficit d and size n gets
    ``ceil(d/n)`` variants, the generated rows are cut at exactly ``d`` in seeded order, appended to
    the originals.  ``augmenter`` maps ``(id, variant_no, text, label)`` to the same columns with new
    text (N6); by default the built-in EDA variants."""
    src = df.filter(F.col(label).isNotNull())
    d = deficits(src, label, target).filter(F.col("deficit") > 0)
    gen = src.join(d, label)  # one row per class
    gen = gen.withColumn("variant_no", F.explode(F.sequence(F.lit(1), F.col("variants").cast("int"))))
    key = F.md5(F.concat_ws(":", F.col(id_col).cast("string"), F.col("variant_no").cast("string"), F.lit(str(seed))))
    gen = rank_within(gen, [label], key, out="__p").filter(F.col("__p") < F.col("deficit"))
    gen = gen.select(id_col, "variant_no", text, label)
    if augmenter is None:
        gen = default_augment(gen, text, id_col, "variant_no", seed)
    else:
        gen = augmenter(gen)
    orig = src.select(id_col, F.lit(0).alias("variant_no"), text, label)
    return orig.unionByName(gen.select(id_col, "variant_no", text, label))


def augment_class(df: DataFrame, cls: str, n: int = 5, label: str = "label", text: str = "text",
                  id_col: str = "id", seed: int = 42) -> DataFrame:
    """M7: ``n`` variants of every text of one class (then :func:`balanced_sample`)."""
    src = df.filter(F.col(label) == cls).select(id_col, text, label)
    gen = src.withColumn("variant_no", F.explode(F.sequence(F.lit(1), F.lit(n))))
    gen = default_augment(gen, text, id_col, "variant_no", seed)
    return src.withColumn("variant_no", F.lit(0)).unionByName(gen)


def review_sample(df: DataFrame, n: int = 50, seed: int = 42, id_col: str = "id") -> DataFrame:
    """M8: seeded sample of ``n`` rows for manual review (the limit is the feature)."""
    return df.orderBy(hash_order(id_col, seed)).limit(n)


def augment_errors(df: DataFrame, pred: str = "pred", gold: str = "label", target: int = 100,
                   **kw) -> DataFrame:
    """M9: augment the rows the model got wrong, by gold class, up to ``target`` per class."""
    wrong = df.filter(F.col(pred).isNotNull() & (F.col(pred) != F.col(gold)))
    return augment_to_target(wrong, gold, target, **kw)


def prompt_table(df: DataFrame, templates: Sequence[str], text: str = "text", id_col: str = "id",
                 placeholder: str = "{text}") -> DataFrame:
    """One prompt row per (row, template) for an outside generator.  The templates are a short
    literal list, so this is an ``explode`` per row, not a join."""
    out = df.select(id_col, text, F.posexplode(F.array(*[F.lit(x) for x in templates])).alias("template_no", "__t"))
    return out.select(id_col, "template_no", F.replace(F.col("__t"), F.lit(placeholder), F.col(text)).alias("prompt"))
