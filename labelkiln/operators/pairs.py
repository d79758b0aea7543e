"""Pair, triplet and batch building for contrastive training data.

No operator here emits all pairs of a group.  Rows get their exact position inside their label in a
seeded hash order (:func:`labelkiln.operators.ranking.rank_within`, skew-safe), and partners are
found by an equi-join on ``(label, position)``: the j-th positive of an anchor is the row j places
after it in its own label (cyclic), the j-th negative is the row at the same position (modulo size)
in the j-th next label.  Output grows linearly with ``rows x per_anchor``; the per-anchor count is the
sampling parameter of these operators.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from labelkiln.functions import vector as V
from labelkiln.operators.ranking import global_rank, hash_order, rank_within


def positions(df: DataFrame, label: str = "label", id_col: str = "id", seed: int = 42) -> DataFrame:
    """``(id, label, pos, n, li, n_labels)``: position in label, label size, label index."""
    src = df.filter(F.col(label).isNotNull())
    r = rank_within(src.select(id_col, label), [label], hash_order(id_col, seed), out="pos")
    sizes = src.groupBy(label).agg(F.count("*").cast("bigint").alias("n"))
    # label table is bounded by the vocabulary: index it with a window over that small table
    idx = sizes.select(label, "n", (F.row_number().over(Window.orderBy(label)) - 1).alias("li"),
                       F.count("*").over(Window.partitionBy()).alias("n_labels"))
    return r.join(idx, label)


def positive_pairs(df: DataFrame, per_anchor: int = 1, label: str = "label", id_col: str = "id",
                   seed: int = 42) -> DataFrame:
    """Unordered same-label pairs ``(a, b, label)`` with ``a < b``; each row is paired with the
    next ``per_anchor`` rows of its label in hash order (all pairs when the label is that small)."""
    p = positions(df, label, id_col, seed)
    a = p.select(F.col(id_col).alias("a"), label, "pos", "n",
                 F.explode(F.sequence(F.lit(1), F.least(F.lit(per_anchor), F.col("n") - 1))).alias("j"))
    # Spark's sequence(1, 0) counts down, so bound j explicitly: labels of one row have no pair
    a = a.filter((F.col("j") >= 1) & (F.col("j") <= F.col("n") - 1))
    a = a.withColumn("ppos", F.pmod(F.col("pos") + F.col("j"), F.col("n")))
    b = p.select(F.col(id_col).alias("b"), F.col(label).alias("__l"), F.col("pos").alias("ppos"))
    j = a.join(b, (a[label] == b["__l"]) & (a["ppos"] == b["ppos"]))
    return (j.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"), label)
            .dropDuplicates(["a", "b"]))


def negative_pairs(df: DataFrame, per_anchor: int = 1, label: str = "label", id_col: str = "id",
                   seed: int = 42) -> DataFrame:
    """``(anchor, negative, anchor_label, negative_label)``: for j = 1..per_anchor, the row at the
    anchor's position (mod size) in the j-th next label (cyclic over the sorted vocabulary)."""
    p = positions(df, label, id_col, seed)
    a = p.select(F.col(id_col).alias("anchor"), F.col(label).alias("anchor_label"), "pos", "li", "n_labels",
                 F.explode(F.sequence(F.lit(1), F.least(F.lit(per_anchor), F.col("n_labels") - 1))).alias("j"))
    a = a.filter((F.col("j") >= 1) & (F.col("j") <= F.col("n_labels") - 1))
    a = a.withColumn("nli", F.pmod(F.col("li") + F.col("j"), F.col("n_labels")))
    sizes = p.select(F.col("li").alias("nli"), F.col("n").alias("nn"), F.col(label).alias("negative_label")
                     ).distinct()
    a = a.join(sizes, "nli").withColumn("npos", F.pmod(F.col("pos"), F.col("nn")))
    b = p.select(F.col(id_col).alias("negative"), F.col("li").alias("nli"), F.col("pos").alias("npos"))
    return a.join(b, ["nli", "npos"]).select("anchor", "negative", "anchor_label", "negative_label")


def triplets(df: DataFrame, per_anchor: int = 1, label: str = "label", id_col: str = "id",
             seed: int = 42) -> DataFrame:
    """``(anchor, positive, negative)``; the j-th triplet of an anchor uses its j-th positive and
    j-th negative as defined above.  Anchors of single-row labels have no triplet."""
    p = positions(df, label, id_col, seed)
    a = p.select(F.col(id_col).alias("anchor"), label, "pos", "n", "li", "n_labels",
                 F.explode(F.sequence(F.lit(1), F.least(F.lit(per_anchor), F.col("n") - 1,
                                                         F.col("n_labels") - 1))).alias("j"))
    a = a.filter((F.col("j") >= 1) & (F.col("j") <= F.col("n") - 1) & (F.col("j") <= F.col("n_labels") - 1))
    a = (a.withColumn("ppos", F.pmod(F.col("pos") + F.col("j"), F.col("n")))
         .withColumn("nli", F.pmod(F.col("li") + F.col("j"), F.col("n_labels"))))
    sizes = p.select(F.col("li").alias("nli"), F.col("n").alias("nn")).distinct()
    a = a.join(sizes, "nli").withColumn("npos", F.pmod(F.col("pos"), F.col("nn")))
    pos_side = p.select(F.col(id_col).alias("positive"), F.col(label).alias("__pl"), F.col("pos").alias("ppos"))
    neg_side = p.select(F.col(id_col).alias("negative"), F.col("li").alias("nli"), F.col("pos").alias("npos"))
    t = a.join(pos_side, (a[label] == pos_side["__pl"]) & (a["ppos"] == pos_side["ppos"]))
    t = t.join(neg_side, ["nli", "npos"])
    return t.select("anchor", "positive", "negative", label)


def label_batches(df: DataFrame, per_label: int = 4, label: str = "label", id_col: str = "id",
                  seed: int = 42) -> DataFrame:
    """Batch number per row so that each batch holds ``per_label`` rows of every label that
    still has rows: ``batch = floor(position_in_label / per_label)``."""
    p = positions(df, label, id_col, seed)
    return p.select(id_col, label, F.floor(F.col("pos") / per_label).cast("bigint").alias("batch"))


def mixed_batches(df: DataFrame, batch_size: int = 16, label: str = "label", id_col: str = "id",
                  seed: int = 42) -> DataFrame:
    """Batches of exactly ``batch_size`` rows (the last one: what is left) that hold several labels.

    Row ``k`` of a label of ``n`` rows stands at ``(k + 1/2) / n`` of the whole order, so every stretch of it holds the labels
    in about their shares of all rows, and no batch at the end is left with one label.  Exact ranks, no single-partition sort.
    """
    p = positions(df, label, id_col, seed).withColumn("__place", (F.col("pos") + 0.5) / F.col("n"))
    r = global_rank(p.select(id_col, label, "__place"), [F.col("__place"), F.col(label)], out="__rank")
    return r.select(id_col, label, F.floor((F.col("__rank") - 1) / batch_size).cast("bigint").alias("batch"))


def variant_pairs(originals: DataFrame, variants: DataFrame, id_col: str = "id", text: str = "text") -> DataFrame:
    """A text with each of its own augmented variants (equi-join on the key)."""
    v = variants.select(id_col, "variant_no", F.col(text).alias("variant"))
    return originals.select(id_col, text).join(v, id_col)


def with_vectors(pairs: DataFrame, vectors: DataFrame, cols: list[str], id_col: str = "id",
                 vec: str = "vec") -> DataFrame:
    """Attach the vector of each id column of a pair/triplet table (one key join per column)."""
    out = pairs
    for c in cols:
        out = out.join(vectors.select(F.col(id_col).alias(c), F.col(vec).alias(f"{c}_vec")), c)
    return out


def triplet_loss(tr: DataFrame, margin: float = 0.5, metric: str = "cosine") -> DataFrame:
    """Per triplet the margin check ``d(a,p) + m < d(a,n)`` and hinge ``max(0, d(a,p) - d(a,n) + m)``;
    ``tr`` holds ``anchor_vec, positive_vec, negative_vec``."""
    if metric == "cosine":
        dp = 1 - V.cosine("anchor_vec", "positive_vec")
        dn = 1 - V.cosine("anchor_vec", "negative_vec")
    else:
        def dist(a, b):
            z = F.zip_with(V.as_double(a), V.as_double(b), lambda x, y: (x - y) * (x - y))
            return F.sqrt(F.aggregate(z, F.lit(0.0), lambda acc, x: acc + x))
        dp, dn = dist("anchor_vec", "positive_vec"), dist("anchor_vec", "negative_vec")
    return tr.withColumn("d_pos", dp).withColumn("d_neg", dn).withColumn(
        "satisfied", F.col("d_pos") + margin < F.col("d_neg")).withColumn(
        "loss", F.greatest(F.lit(0.0), F.col("d_pos") - F.col("d_neg") + margin))


def info_nce(scored: DataFrame, temperature: float = 0.1, anchor: str = "anchor", sim: str = "sim",
             is_pos: str = "is_pos") -> DataFrame:
    """Per anchor ``-ln(exp(s+/t) / sum exp(s/t))`` over its positive and its negatives: one
    groupBy of bounded groups (1 + per_anchor rows).  Similarities are cosines in [-1, 1], so
    ``exp(s/t)`` cannot overflow for any sensible temperature."""
    g = scored.groupBy(anchor).agg(
        F.max(F.when(F.col(is_pos), F.col(sim))).alias("__sp"),
        F.sum(F.exp(F.col(sim) / temperature)).alias("__z"))
    return g.filter(F.col("__sp").isNotNull()).select(
        anchor, (F.log("__z") - F.col("__sp") / temperature).alias("loss"))
