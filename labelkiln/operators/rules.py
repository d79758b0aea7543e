"""Labelling rules.

A rule is a small object holding a Spark ``Column`` predicate and the label it votes for.  Applying
any number of rules is ONE narrow projection over the table (no shuffle); rules that need another
table (knowledge base, prototypes) first attach their hit column with a join whose small side is
size-checked.  Votes are strings (the label) or NULL (abstain); ``NONE`` is the vote of a negative
rule.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labelkiln.functions import text as tx
from labelkiln.operators.tokens import frequent, looked_up

NONE = "__none__"  # vote of a negative rule: "this row is not relevant"


@dataclass
class LF:
    """A labelling function: vote ``label`` where its predicate holds, else abstain.

    ``build`` returns the predicate ``Column``; it is called when the rule is applied, so rules can
    be declared (and their SQL twins read) without a running Spark session.
    """

    name: str
    label: str
    build: Callable[[], Column] | Column | None = None
    sql: str | None = None  # DuckDB twin of the predicate (oracle only)
    prepare: Callable[[DataFrame], DataFrame] | None = None  # adds columns the predicate reads
    drop_after: Sequence[str] = field(default_factory=tuple)

    @property
    def predicate(self) -> Column:
        return self.build() if callable(self.build) else self.build

    def vote(self) -> Column:
        return F.when(self.predicate, F.lit(self.label)).otherwise(F.lit(None).cast("string"))

    def vote_sql(self) -> str:
        return f"CASE WHEN {self.sql} THEN '{self.label}' END"


def keyword_lf(name: str, label: str, words: Sequence[str], text: str = "text",
               literal: bool = True) -> LF:
    """Whole-word, any-case keyword rule (one alternation, one regex pass)."""
    words = list(words)
    return LF(name, label, lambda: tx.has_keyword(text, words, literal),
              f"regexp_matches({text}, '{tx.keyword_regex_sql(words, literal)}')")


def regex_lf(name: str, label: str, pattern: str, text: str = "text", sql_pattern: str | None = None) -> LF:
    """Regular-expression rule (Java syntax; give ``sql_pattern`` when RE2 differs)."""
    return LF(name, label, lambda: F.col(text).rlike(pattern),
              f"regexp_matches({text}, '{sql_pattern or pattern}')")


@dataclass
class ListLF:
    """A labelling function that votes for any number of labels; ``build`` returns ``array<string>``.

    An empty or NULL array abstains, and NULL labels in it are ignored.
    """

    name: str
    build: Callable[[], Column]
    sql: str | None = None  # DuckDB twin: a list (oracle only)

    def votes(self) -> Column:
        return F.coalesce(self.build(), F.array().cast("array<string>"))

    def votes_sql(self) -> str:
        return f"coalesce({self.sql}, [])"


def topics_lf(name: str, topics: dict[str, Sequence[str]], text: str = "text") -> ListLF:
    """Every label of ``topics`` (label -> keywords) with a keyword in the text."""
    lfs = [keyword_lf(label, label, words, text) for label, words in topics.items()]
    return ListLF(name, lambda: F.array(*[lf.vote() for lf in lfs]), "[" + ", ".join(lf.vote_sql() for lf in lfs) + "]")


def merge_votes(lfs: Sequence[LF | ListLF]) -> Column:
    """Distinct, sorted labels of a row over rules with one label and rules with several."""
    lists = [lf.votes() if isinstance(lf, ListLF) else F.array(lf.vote()) for lf in lfs]
    return F.array_sort(F.array_distinct(F.filter(F.flatten(F.array(*lists)), lambda x: x.isNotNull())))


def merge_votes_sql(lfs: Sequence[LF | ListLF]) -> str:
    lists = ", ".join(lf.votes_sql() if isinstance(lf, ListLF) else f"[{lf.vote_sql()}]" for lf in lfs)
    return f"list_sort(list_distinct(list_filter(flatten([{lists}]), lambda x: x IS NOT NULL)))"


def negative_lf(name: str, words: Sequence[str], text: str = "text") -> LF:
    """Negative keyword rule; its vote marks the row as not relevant and overrides labels."""
    return keyword_lf(name, NONE, words, text)


def score_lf(name: str, label: str, score_col: str, op: str, threshold: float) -> LF:
    """Rule on a score from an auxiliary model, e.g. ``sentiment < -0.5 -> complaint``."""
    ops = {"<": lambda c: c < threshold, "<=": lambda c: c <= threshold,
           ">": lambda c: c > threshold, ">=": lambda c: c >= threshold}
    return LF(name, label, lambda: ops[op](F.col(score_col)), f"{score_col} {op} {threshold}")


def column_lf(name: str, label: str, predicate: Column | Callable[[], Column], sql: str | None = None) -> LF:
    """Any user predicate written as a Spark column (or a function returning one)."""
    return LF(name, label, predicate, sql)


def pandas_lf(name: str, label: str, fn: Callable, text: str = "text") -> LF:
    """N1 slow path: Python-only logic as an Arrow-batched ``pandas_udf`` returning booleans."""
    from pyspark.sql.functions import pandas_udf

    @pandas_udf("boolean")
    def _hit(s: pd.Series) -> pd.Series:
        return s.map(lambda v: bool(fn(v)) if v is not None else False)

    def build() -> Column:
        from pyspark.sql import SparkSession

        from labelkiln.session import ship_package
        ship_package(SparkSession.active())
        return _hit(F.col(text))

    return LF(name, label, build)


def kb_lf(name: str, label: str, kb: DataFrame, term_col: str = "term", text: str = "text",
          id_col: str = "id") -> LF:
    """The text contains a term from an external table (e.g. an ingredient list).

    Tokens of each row are exploded and joined to the distinct, lower-cased terms (see :func:`kb_hits`).  Only (id) of
    matching rows is kept, then joined back on the key.
    """
    hit = f"__kb_{name}"

    def prepare(df: DataFrame) -> DataFrame:
        return df.join(kb_hits(df, kb, term_col, text, id_col).withColumn(hit, F.lit(True)),
                       id_col, "left")

    return LF(name, label, lambda: F.coalesce(F.col(hit), F.lit(False)), prepare=prepare, drop_after=(hit,))


def kb_hits(df: DataFrame, kb: DataFrame, term_col: str = "term", text: str = "text",
            id_col: str = "id") -> DataFrame:
    """Ids whose text contains at least one knowledge-base term (whole token).

    Frequent tokens, which a third of all rows may hold, are looked up apart from the rest (see
    :func:`labelkiln.operators.tokens.looked_up`)."""
    terms = kb.select(F.lower(F.col(term_col)).alias("tok")).filter("tok IS NOT NULL").distinct().withColumn("__hit", F.lit(True))
    toks = df.select(id_col, F.explode(F.array_distinct(tx.words(text))).alias("tok"))
    head = frequent(toks, "tok")
    return looked_up(toks, terms, "tok", head).filter("__hit").select(id_col).distinct()


def _prepared(df: DataFrame, lfs: Sequence[LF]) -> DataFrame:
    for lf in lfs:
        if lf.prepare is not None:
            df = lf.prepare(df)
    return df


def _dropped(df: DataFrame, lfs: Sequence[LF]) -> DataFrame:
    cols = [c for lf in lfs for c in lf.drop_after]
    return df.drop(*cols) if cols else df


def apply_lfs(df: DataFrame, lfs: Sequence[LF], prefix: str = "") -> DataFrame:
    """One column per rule holding its vote (wide label matrix); a single projection."""
    out = _prepared(df, lfs)
    out = out.select("*", *[lf.vote().alias(prefix + lf.name) for lf in lfs])
    return _dropped(out, lfs)


def label_matrix(df: DataFrame, lfs: Sequence[LF], classes: Sequence[str], id_col: str = "id",
                 col: str = "L") -> DataFrame:
    """J7 in the classic integer form: ``array<int>`` of class indexes, -1 = abstain."""
    idx = {c: i for i, c in enumerate(classes)}

    def code(lf: LF) -> Column:
        return F.when(lf.predicate, F.lit(idx[lf.label])).otherwise(F.lit(-1))

    out = _prepared(df, lfs)
    return _dropped(out.select(id_col, F.array(*[code(lf) for lf in lfs]).alias(col)), lfs)


def votes_long(df: DataFrame, lfs: Sequence[LF], id_col: str = "id") -> DataFrame:
    """J7 long form ``(id, lf, vote)`` without abstains; a narrow ``inline`` per row."""
    out = _prepared(df, lfs)
    pairs = F.array(*[F.struct(F.lit(lf.name).alias("lf"), lf.vote().alias("vote")) for lf in lfs])
    return (out.select(id_col, F.inline(pairs)).filter(F.col("vote").isNotNull()))


def merge_labels(cols: Sequence[str | Column]) -> Column:
    """Distinct, sorted non-null votes of a row (Q18: order is fixed, not a set's order)."""
    arr = F.array(*[F.col(c) if isinstance(c, str) else c for c in cols])
    return F.array_sort(F.array_distinct(F.filter(arr, lambda x: x.isNotNull())))


def union_label(df: DataFrame, lfs: Sequence[LF], label: str = "label", relevance: str = "relevance",
                out: str = "weak_label", sep: str = ", ") -> DataFrame:
    """Label the unlabelled rows by the union of rule votes.

    Labelled rows keep their label.  An unlabelled row with at least one positive vote gets the
    joined, sorted labels and relevance 1; a negative vote (J3) overrides positives and leaves the
    row unlabelled with relevance 0.  Rules are only evaluated on unlabelled rows (lazy CASE; Arrow-batched rules
    of :func:`pandas_lf` see every row).
    """
    unlabelled = F.col(label).isNull()
    voted = _prepared(df, lfs)
    voted = _dropped(voted.select("*", *[F.when(unlabelled, lf.vote()).alias(f"__lf_{lf.name}") for lf in lfs]), lfs)
    vote_cols = [f"__lf_{lf.name}" for lf in lfs]
    merged = merge_labels(vote_cols)
    neg = F.array_contains(merged, NONE)
    pos = F.filter(merged, lambda x: x != NONE)
    unl = F.col(label).isNull()
    new = F.when(unl & ~neg & (F.size(pos) > 0), F.array_join(pos, sep))
    res = voted.select(
        *[c for c in df.columns if c not in (relevance,)],
        F.when(unl & ~neg & (F.size(pos) > 0), F.lit(1)).when(unl & neg, F.lit(0))
         .otherwise(F.col(relevance)).alias(relevance),
        F.coalesce(F.col(label), new).alias(out),
    )
    return res


def union_label_sql(base_sql: str, lfs: Sequence[LF], label: str = "label", relevance: str = "relevance",
                    out: str = "weak_label", cols: Sequence[str] = ("id",), sep: str = ", ") -> str:
    """DuckDB twin of :func:`union_label` over a base query."""
    votes = ", ".join(lf.vote_sql() for lf in lfs)
    merged = f"list_sort(list_distinct(list_filter([{votes}], lambda x: x IS NOT NULL)))"
    return (f"SELECT {', '.join(cols)}, "
            f"CASE WHEN {label} IS NULL AND NOT list_contains(m, '{NONE}') AND len(p) > 0 THEN 1 "
            f"WHEN {label} IS NULL AND list_contains(m, '{NONE}') THEN 0 ELSE {relevance} END AS {relevance}, "
            f"coalesce({label}, CASE WHEN NOT list_contains(m, '{NONE}') AND len(p) > 0 "
            f"THEN array_to_string(p, '{sep}') END) AS {out} "
            f"FROM (SELECT *, list_filter(m, lambda x: x <> '{NONE}') AS p FROM "
            f"(SELECT *, {merged} AS m FROM ({base_sql}) b) s) t")


def relevance_from_label(label: str | Column) -> Column:
    """Relevance 0 when the label is missing/abstain, else 1."""
    c = F.col(label) if isinstance(label, str) else label
    return F.when(c.isNull(), 0).otherwise(1)
