"""Order MinHash fingerprints of documents, with DataFrame functions only.

A text is cut into words, and every run of ``k`` words is a k-mer.  Equal k-mers of one text are numbered
by occurrence, so that a k-mer and its repeats are different elements.  For each of ``bins`` bins the ``tuple_size``
smallest elements of the whole text, in an order of the bin's own, are selected, put back in the order of the text, and
hashed as one tuple.  Two texts agree in a bin only if they select the same elements in the same order, which
is what makes the signature follow edit distance rather than set overlap.

The orders are those of SuperMinHash: an element visits all bins in a permutation of its own, and a bin's order is by
round of the visit, then by a hash of element and round.  A bin that round 0 fills needs no later one, so long texts
need a single round, and short ones as many as it takes.

All of it happens inside the row, in sorts of an array of longs; a text never leaves its row to
be fingerprinted.  The neighbour comparison moves each text once, in blocks of consecutive ids.

Defined results: null text counts as empty; a text without words has only empty bins; two texts that
have all bins empty have likeness 1; white space never counts.  Texts of up to 2**28 words.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from labelkiln.llm.common import LOWEST, block_of, let, null_text, partitions, upper_splitters

K, BINS, TUPLE = 3, 64, 2
LONG, GRAM = 24, 8
_POS = (1 << 28) - 1
#: The characters of [\x20\x09-\x0D].
SPACES = " \t\n\x0b\x0c\r"


def _run_starts(sorted_values: Column, drop_bits: int) -> Column:
    """Indexes in a sorted array of longs where the bits above ``drop_bits`` change."""
    return F.filter(
        F.sequence(F.lit(0), F.size(sorted_values) - 1),
        lambda i: (i == 0) | (F.shiftright(F.get(sorted_values, i), drop_bits)
                              != F.shiftright(F.get(sorted_values, i - 1), drop_bits)))


def _runs(sorted_values: Column, drop_bits: int, per_run) -> Column:
    """``per_run(run)`` for each run of equal upper bits of a sorted, non-empty array."""
    return let(_run_starts(sorted_values, drop_bits), lambda starts: F.transform(
        starts, lambda s, r: per_run(F.slice(
            sorted_values, s + 1, F.coalesce(F.get(starts, r + 1), F.size(sorted_values)) - s))))


def pieces(text: Column) -> Column:
    """The words of a text; a word of more than ``LONG`` characters (a script without spaces, encoded data) is
    taken as its overlapping runs of ``GRAM`` characters, so that an edit changes only the runs it touches."""
    spaced = null_text(text)
    for c in SPACES[1:]:
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    words = F.array_remove(F.split(spaced, " ", -1), "")
    grams = lambda w: let(F.split(w, ""), lambda cs: F.transform(
        F.sequence(F.lit(0), F.size(cs) - GRAM), lambda i: F.array_join(F.slice(cs, i + 1, F.lit(GRAM)), "")))
    is_long = lambda w: F.char_length(w) > LONG
    return let(words, lambda ws: F.when(F.exists(ws, is_long), F.flatten(F.transform(
        ws, lambda w: F.when(is_long(w), grams(w)).otherwise(F.array(w))))).otherwise(ws))


def order_minhash(text: Column, k: int = K, bins: int = BINS, tuple_size: int = TUPLE, whole: bool = False) -> Column:
    """Ascending ``array<long>`` of (bin, 32-bit tuple hash), one for each bin that has elements.

    ``whole``: every bin selects among all elements of the text.  Otherwise only among those of round 0 (one permutation);
    then bins of short texts hold few elements or none.

    An element is a long: from the top, after a zero sign, the bin, the hash and 28 bits of position, so
    that one sort orders a text's elements by bin and hash.
    """
    if bins not in (16, 32, 64, 128):
        raise ValueError("bins must be 16, 32, 64 or 128")
    bin_shift = 63 - (bins.bit_length() - 1)
    hash_bits = ((1 << 63) - 1) & ~_POS
    round_shift = 2 * bin_shift - 63

    def kmers(words: Column) -> Column:
        n = F.greatest(F.size(words) - (k - 1), F.lit(1))
        return F.transform(F.slice(words, 1, n), lambda w, i: F.xxhash64(
            w, *[F.get(words, i + j) for j in range(1, k)]).bitwiseAND(F.lit(hash_bits)))

    def placed(ks: Column) -> Column:
        return F.sort_array(F.transform(ks, lambda h, i: h.bitwiseOR(i.cast("long"))))

    def numbered(es: Column) -> Column:
        """Occurrence numbers: the j-th repeat of a k-mer gets a hash of its own.  Only k-mers that do
        repeat (equal neighbours in the sorted array) are taken apart."""
        same = lambda x, i: F.shiftright(x, 28) == F.shiftright(F.get(es, i), 28)
        beside = lambda x, i: F.coalesce(same(x, i - 1), F.lit(False)) | F.coalesce(same(x, i + 1), F.lit(False))
        repeats = F.filter(es, beside)
        own = lambda run: F.transform(run, lambda x, j: F.when(j == 0, x).otherwise(
            F.xxhash64(F.shiftright(x, 28), j).bitwiseAND(F.lit(hash_bits)).bitwiseOR(x.bitwiseAND(F.lit(_POS)))))
        return F.sort_array(F.concat(F.filter(es, lambda x, i: ~beside(x, i)),
                                     let(repeats, lambda r: F.flatten(_runs(r, 28, own)))))

    def elements(ks: Column) -> Column:
        return F.when(F.size(F.array_distinct(ks)) == F.size(ks), placed(ks)).otherwise(
            let(placed(ks), numbered))

    def minimal(es: Column) -> Column:
        return F.filter(es, lambda x, i: (i < tuple_size) | (
            F.shiftright(x, bin_shift) != F.shiftright(F.get(es, i - tuple_size), bin_shift)))

    def thrown(es: Column, rounds: Column) -> Column:
        """Sorted visits of the first ``rounds`` rounds: bin, round, hash, and 28 bits of index in ``es``."""
        at = lambda b, r, i: F.shiftleft(b.cast("long"), bin_shift).bitwiseOR(
            F.shiftleft(r.cast("long"), round_shift)).bitwiseOR(i.cast("long"))
        place = lambda x, r: (F.shiftright(x, bin_shift) + r * (
            F.shiftright(x, 28).bitwiseAND(F.lit(bins // 2 - 1)) * 2 + 1)).bitwiseAND(F.lit(bins - 1))
        later = F.transform(es, lambda x, i: F.transform(F.sequence(F.lit(1), rounds - 1), lambda r: at(
            place(x, r), r, i).bitwiseOR(F.shiftleft(F.shiftrightunsigned(
                F.xxhash64(F.shiftright(x, 28), r), 64 - (round_shift - 28)), 28))))
        return F.sort_array(F.concat(F.transform(es, lambda x, i: at(F.shiftright(x, bin_shift), F.lit(0), i)), F.flatten(later)))

    def selected(es: Column) -> Column:
        """The first ``tuple_size`` visits of each bin; all rounds where a few did not fill every bin."""
        some = F.least(F.lit(bins), F.lit(2) + F.floor(F.lit(16 * bins) / F.size(es)).cast("int"))
        first = lambda rounds: let(thrown(es, rounds), minimal)
        return let(first(some), lambda vs: F.when(
            F.size(vs) == F.least(F.size(es), F.lit(tuple_size)) * bins, vs).otherwise(first(F.lit(bins))))

    def tuple_hash(run: Column, register: Column | None = None) -> Column:
        # position to the top, hash below it: sorting restores the order of the text
        in_text_order = F.sort_array(F.transform(run, lambda x: F.shiftleft(x.bitwiseAND(F.lit(_POS)), 35)
                                                 .bitwiseOR(F.shiftright(x, 28))))
        h = F.hash(F.transform(in_text_order, lambda x: x.bitwiseAND(F.lit((1 << 35) - 1)))).cast("long")
        register = F.shiftright(F.element_at(run, 1), bin_shift) if register is None else register
        return F.shiftleft(register, 32).bitwiseOR(h.bitwiseAND(F.lit(0xFFFFFFFF)))

    def from_all(es: Column) -> Column:
        return let(selected(es), lambda vs: _runs(vs, bin_shift, lambda run: tuple_hash(
            F.transform(run, lambda v: F.get(es, v.bitwiseAND(F.lit(_POS)).cast("int"))),
            F.shiftright(F.element_at(run, 1), bin_shift))))

    def signature(words: Column) -> Column:
        dealt = lambda ms: _runs(ms, bin_shift, tuple_hash)
        return let(kmers(words), lambda ks: let(elements(ks), lambda es: let(
            minimal(es), lambda ms: F.when(F.size(ms) == tuple_size * bins, dealt(ms)).otherwise(from_all(es))
            if whole else dealt(ms))))

    return let(pieces(text), lambda w: F.when(F.size(w) > 0, signature(w))
               .otherwise(F.array().cast("array<bigint>")))


def fingerprint_text(signature: Column) -> Column:
    """The signature as a string: 11 hex digits a filled bin (1, the bin, the tuple hash)."""
    return F.array_join(F.transform(signature, lambda h: F.hex(h + F.lit(1 << 40))), "")


def likeness(a: Column, b: Column) -> Column:
    """Share of bins with equal tuples, among the bins that either text fills (none: 1)."""
    bins = lambda s: F.transform(s, lambda h: F.shiftright(h, 32))
    filled = F.when((F.size(a) == BINS) | (F.size(b) == BINS), F.lit(BINS)).otherwise(
        F.size(F.array_union(bins(a), bins(b))))
    return F.when(filled == 0, F.lit(1.0)).otherwise(F.size(F.array_intersect(a, b)) / filled)


def with_next(df: DataFrame, id_col: str, carry: list[str]) -> DataFrame:
    """Add ``next_<c>`` for each column of ``carry``: its value in the next row by descending id, and
    for the last row that of the first.

    Blocks of consecutive ids are cut at quantiles; each block also gets a copy of the row that starts
    the block after it, so one exchange and a window within blocks suffice.  Null ids come last; rows
    of one id follow each other in the order of a hash of ``carry``.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_key", F.coalesce(F.col(id_col).cast("long"), F.lit(LOWEST)))
    cuts = upper_splitters(keyed, "_key", 4 * partitions(spark))
    block = block_of(F.col("_key"), cuts)
    at = lambda b, copy: F.struct(b.cast("int").alias("block"), F.lit(copy).alias("copy"))
    is_cut = F.array_contains(F.array(*[F.lit(c).cast("long") for c in cuts]), F.col("_key"))
    placed = keyed.withColumn("_block", block).withColumn("_at", F.explode(F.when(
        is_cut, F.array(at(F.col("_block"), False), at(F.pmod(F.col("_block") + 1, F.lit(len(cuts))), True)))
        .otherwise(F.array(at(F.col("_block"), False)))))
    order = Window.partitionBy("_at.block").orderBy(
        F.col("_at.copy"), F.col("_key").desc(), F.xxhash64(*carry))
    ahead = placed.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in carry])
    return ahead.filter(~F.col("_at.copy")).drop("_key", "_block", "_at")


def edit_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      k: int = K, bins: int = BINS, tuple_size: int = TUPLE) -> DataFrame:
    """Fingerprints of each text and of its edited text, and their likeness.

    The edited text has its last ``floor(n/2)`` code points replaced by the first as many of the next
    document.  Other columns of ``docs`` are ignored.  Returns ``doc_id, n_chars, text, edited,
    signature, edited_signature, next_signature``.
    """
    base = docs.select(F.col(id_col).alias("doc_id"), null_text(F.col(text_col)).alias("text"))
    base = base.withColumn("signature", order_minhash(F.col("text"), k, bins, tuple_size, whole=True))
    ahead = with_next(base, "doc_id", ["text", "signature"])
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    edited = ahead.select(
        "doc_id", n.cast("long").alias("n_chars"), "text", "signature",
        F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"),
        F.col("next_signature"))
    return edited.withColumn("edited_signature", order_minhash(F.col("edited"), k, bins, tuple_size, whole=True))


def fingerprint_report(docs: DataFrame) -> DataFrame:
    """The digest columns of ``op1``."""
    e = edit_fingerprints(docs)
    return e.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_text(F.col("signature")).alias("fingerprint"),
        fingerprint_text(F.col("edited_signature")).alias("edited_fingerprint"),
        likeness(F.col("signature"), F.col("edited_signature")).alias("near_edited"),
        likeness(F.col("signature"), F.col("next_signature")).alias("near_next"))
