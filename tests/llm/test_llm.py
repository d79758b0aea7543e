"""Each operator against a brute-force version, on a fixture with nulls, empty and long texts, ties,
repeated rows, clashing column names and empty tables."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from labelkiln.llm import (
    exact_dedup, fingerprints, line_dedup, mixing, near_dedup, packing, quality, shards, simple8b, token_files, toxicity,
)
from labelkiln.llm.queries import QUERIES, SQL, _tokenizer

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
SF = "/root/testdata/sf0.001"
WS = re.compile(r"[\x20\x09-\x0D]+")


def words(text):
    return [w for w in WS.split(text or "") if w]


def make_rows():
    rnd = random.Random(5)
    vocab = ["".join(rnd.choices("abcdeéñß", k=rnd.randint(2, 7))) for _ in range(300)]
    text = lambda n: " ".join(rnd.choices(vocab, k=n))
    texts = [text(rnd.randint(1, 120)) for _ in range(60)]
    for t in texts[:12]:
        texts += [t, t.upper() if t.isascii() else t, t.replace(" ", "  "), t + "\n"]
        w = t.split()
        for _ in range(4):
            v = list(w)
            v[rnd.randrange(len(v))] = "edited"
            texts.append(" ".join(v))
    base = text(200).split()
    for i in range(40):  # a large group of near copies, all texts different
        v = list(base)
        v[i * 5 % 200] = f"x{i}"
        texts.append(" ".join(v))
    texts += ["", None, " ", "\n\n", "a", "a b", "a b c", "A b C", "x" * 5000, text(6000), "one line\none line\none  Line\n\nlast",
              "<|endoftext|> and  two   spaces\x1c sep", "日本語のテキストです" * 30, "\x85 next em ", text(30) + "\r\n" + text(20)]
    rows = [(i * 3, t, "en", f"s{i % 4}" if i % 9 else None, len(t or "")) for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (rows[7][0], "same id other text", None, "s0", None), (None, "no id", "en", "s1", 5),
             (None, texts[0], "en", "s1", 5)]
    return rows


@pytest.fixture(scope="module")
def rows():
    return make_rows()


@pytest.fixture(scope="module")
def docs(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    return df.withColumns({"size": F.lit("clash"), "rate": F.lit(1), "h": F.lit(2), "node": F.lit("n"), "block": F.lit(0)}).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def test_empty_tables(spark, empty):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    for df in (fingerprints.fingerprint_report(empty), shards.shard_report(empty), token_files.token_report(empty, _tokenizer()),
               near_dedup.near_groups(empty), exact_dedup.exact_groups(empty), packing.best_fit_pack(empty),
               line_dedup.line_report(empty), toxicity.toxicity_report(empty, none), mixing.mix_report(empty),
               quality.quality_report(empty, none), mixing.mixed(empty), exact_dedup.drop_copies(empty),
               near_dedup.drop_near(empty), quality.accepted(empty, none)):
        assert df.count() == 0


# 1 ---------------------------------------------------------------------------------------------------------------
def test_fingerprints(docs, rows):
    got = fingerprints.fingerprint_report(docs).collect()
    assert len(got) == len(rows)
    ids = [r[0] for r in rows]
    single = {r[0]: r[1] or "" for r in rows if r[0] is not None and ids.count(r[0]) == 1}
    order = sorted(single, reverse=True)
    by_id = {r.doc_id: r for r in got}
    seen = 0
    for a, b in zip(order, order[1:]):
        t, nxt = single[a], single[b]
        if any(x is not None and b <= x <= a and ids.count(x) > 1 for x in ids):
            continue
        h = len(t) // 2
        edited = t[: len(t) - h] + nxt[:h]
        assert by_id[a].n_chars == len(t)
        assert by_id[a].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        if edited == t:
            assert by_id[a].near_edited == 1
        seen += 1
    assert seen > 100
    prints = defaultdict(set)
    for r in got:
        if r.doc_id in single:
            prints[single[r.doc_id]].add(r.fingerprint)
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    assert all(len(p) == 1 for p in prints.values())
    long = [r for r in got if r.doc_id in single and len(words(single[r.doc_id])) > 60]
    assert np.mean([r.near_edited for r in long]) > 0.05


def test_fingerprints_follow_order(spark):
    """Swapping two halves keeps the set of k-mers and still changes the fingerprint; a small edit hardly does."""
    rnd = random.Random(1)
    w = [f"w{rnd.randrange(10**6)}" for _ in range(400)]
    swapped, edit = w[200:] + w[:200], w[:100] + ["other"] + w[101:]
    df = spark.createDataFrame([(" ".join(w), " ".join(swapped), " ".join(edit))], "a string, b string, c string")
    s = {c: fingerprints.order_minhash(F.col(c)) for c in "abc"}
    near = df.select(fingerprints.likeness(s["a"], s["b"]), fingerprints.likeness(s["a"], s["c"])).first()
    assert near[0] < 0.75 < 0.9 < near[1]


def test_fingerprints_of_short_texts(spark):
    """Every tuple is chosen among all k-mers of a text: short texts fill every bin and show the order as long ones do."""
    rnd = random.Random(11)
    rows = []
    for n in (20, 40, 60, 120):
        for _ in range(10):
            w = [f"w{rnd.randrange(10**6)}" for _ in range(n)]
            rows.append((n, " ".join(w), " ".join(w[n // 2 :] + w[: n // 2])))
    df = spark.createDataFrame(rows + [(1, "a b", "a b"), (2, "a b c d", "a b c d")], "n int, a string, b string").repartition(4)
    s = {c: fingerprints.order_minhash(F.col(c), whole=True) for c in "ab"}
    got = df.select("n", F.size(s["a"]).alias("filled"), fingerprints.likeness(s["a"], s["b"]).alias("near"),
                    F.transform(s["a"], lambda x: F.shiftright(x, 32)).alias("bins")).collect()
    assert all(r.bins == list(range(64)) for r in got)
    for n in (20, 40, 60, 120):
        assert 0.2 < np.mean([r.near for r in got if r.n == n]) < 0.58
    assert all(r.near == 1 for r in got if r.n < 3)


def test_fingerprints_without_spaces(spark):
    """An inserted character moves no later piece, and half a text in another script leaves the other half alike."""
    rnd = random.Random(12)
    a = "".join(chr(rnd.randrange(0x4E00, 0x9000)) for _ in range(600))
    english = " ".join(f"w{rnd.randrange(10**4)}" for _ in range(50))
    df = spark.createDataFrame([(a, "日" + a, a[:300] + english, "aa " + "x" * 24 + " " + "ab" * 13)],
                               "a string, b string, c string, d string")
    s = {c: fingerprints.order_minhash(F.col(c), whole=True) for c in "abc"}
    near = df.select(*[fingerprints.likeness(s["a"], s[c]) for c in "bc"], fingerprints.pieces(F.col("d"))).first()
    assert near[0] > 0.9 and near[1] > 0.08
    assert near[2] == ["aa", "x" * 24] + [("ab" * 13)[i : i + 8] for i in range(19)]


def test_fingerprint_elements(spark):
    """The signature equals a plain version of it, repeats included."""
    rnd = random.Random(3)
    text = " ".join(rnd.choices(["aa", "bb", "cc"], k=60))
    w, k, pos = text.split(), 3, (1 << 28) - 1
    df = spark.createDataFrame([(text,)], "t string")
    sig = df.select(fingerprints.order_minhash(F.col("t"))).first()[0]
    hx = lambda *a: df.select(F.xxhash64(*[F.lit(x) for x in a])).first()[0]
    grams = [tuple(w[i : i + k]) for i in range(len(w) - k + 1)]
    mask = ((1 << 63) - 1) & ~pos
    base = {g: hx(*g) & mask for g in set(grams)}
    count, elems = Counter(), []
    for i, g in enumerate(grams):
        j, count[g] = count[g], count[g] + 1
        h = base[g] if j == 0 else df.select(F.xxhash64(F.lit(base[g] >> 28).cast("long"), F.lit(j))).first()[0] & mask
        elems.append(h | i)
    bins = defaultdict(list)
    for x in sorted(elems):
        bins[x >> 57].append(x)
    assert [s >> 32 for s in sig] == sorted(bins)
    for s in sig:
        run = sorted(bins[s >> 32][:2], key=lambda x: x & pos)
        want = df.select(F.hash(F.array(*[F.lit((x >> 28)).cast("long") for x in run]))).first()[0]
        assert s & 0xFFFFFFFF == want & 0xFFFFFFFF


# 2 ---------------------------------------------------------------------------------------------------------------
def test_shards(docs, rows):
    got = shards.shard_report(docs).collect()
    assert len(got) == len(rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t, *_ in rows)
    by = defaultdict(list)
    for r in got:
        by[r.shard].append(r)
        assert r.law == "bytes" and r.grown_shard is None
    assert set(by) <= set(range(8))
    for part in by.values():
        assert sorted(r.slot for r in part) == list(range(len(part)))
    sizes = [sum(r.size for r in by[s]) for s in range(8)]
    total, largest = sum(sizes), max(r.size for r in got)
    assert all(abs(s - total / 8) <= largest + total / 1000 for s in sizes)


def test_shards_of_one_text(spark):
    """A third of all rows, or all of them, with one text: the group is split between its ids."""
    rows = [(i, "same text", None, None, 9) for i in range(900)] + [(5000 + i, f"t{i}", None, None, 2) for i in range(100)]
    got = shards.shard_report(spark.createDataFrame(rows, SCHEMA)).groupBy("shard").agg(F.sum("size").alias("s")).collect()
    assert len(got) == 8 and max(r.s for r in got) - min(r.s for r in got) <= 25


# 3 ---------------------------------------------------------------------------------------------------------------
@pytest.mark.parametrize("seed", range(12))
def test_simple8b_round_trip(seed):
    rnd = np.random.RandomState(seed)
    n = int(rnd.choice([0, 1, 5, 255, 256, 257, 1000, 20000]))
    v = (rnd.randint(0, 1 << 30, n) >> rnd.randint(0, 31, n)).astype(np.uint64)
    if n:
        v[rnd.randint(0, n, n // 50 + 1)] = np.uint64(2**64 - 1 - seed)
    if seed % 3 == 0:
        v[: n // 2] = 0
    w, o, at, ev = simple8b.encode(v)
    assert (simple8b.decode(w, o, n, at, ev) == v).all()
    if seed % 3 == 0 and n > 2000:
        assert len(w) < n
    if n > 600:  # a block is found and decoded by its offset alone
        b = 1
        part = simple8b.decode(w[o[b] : o[b + 1]], np.array([0, o[b + 1] - o[b]]), 256, np.zeros(0), np.zeros(0, np.uint64))
        keep = v[256:512] < (1 << 30)
        assert (part[keep] == v[256:512][keep]).all()


def test_tokens(spark, docs, rows):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(_tokenizer())
    path = os.path.join(spark.sparkContext.getCheckpointDir(), "tokens-test")
    token_files.write_token_files(docs, _tokenizer(), path)
    got = token_files.read_token_files(spark, path, with_ids=True).collect()
    assert len(got) == len(rows)
    want = Counter((i, tuple(tok.encode(t or "", add_special_tokens=False).ids + [0])) for i, t, *_ in rows)
    assert Counter((r.doc_id, tuple(r.ids)) for r in got) == want
    at = 0
    for r in sorted(got, key=lambda r: r.start):
        assert r.start == at and r.n_tokens == len(r.ids)
        assert r.ids_crc32 == zlib.crc32(np.array(r.ids, "<u4").tobytes())
        at += r.n_tokens
    ordered = [r.doc_id for r in sorted(got, key=lambda r: r.start)]
    assert ordered == sorted(ordered, key=lambda x: -1 if x is None else x)


def test_pieces_keep_ids():
    from tokenizers import Tokenizer

    tok, enc = Tokenizer.from_file(_tokenizer()), token_files.Encoder(_tokenizer())
    rnd = random.Random(9)
    alphabet = [" ", "  ", "\n", "\t", " ", " ", "\x1c", "\x85", "a", "bc", "'s", "'", "12", "é", "日", "!", "...", "​", "<|endoftext|>", "I'm"]
    texts = ["".join(rnd.choices(alphabet, k=rnd.randint(0, 25))) for _ in range(3000)]
    for t, got in zip(texts, enc(texts), strict=True):
        assert np.frombuffer(got, "<u4").tolist() == tok.encode(t, add_special_tokens=False).ids, repr(t)


# 4 ---------------------------------------------------------------------------------------------------------------
def brute_near(rows, width, percent):
    low = [words(re.sub("[A-Z]", lambda m: m[0].lower(), r[1] or "")) for r in rows]
    sets = [{tuple(w[i : i + width]) for i in range(max(1, len(w) - width + 1))} if w else set() for w in low]
    up = list(range(len(rows)))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if a and b and 100 * len(a & b) >= percent * len(a | b):
                up[root(i)] = root(j)
    groups = defaultdict(list)
    for i, r in enumerate(rows):
        groups[root(i)].append(r[0])
    name = {g: min((x for x in ids if x is not None), default=None) for g, ids in groups.items()}
    return Counter((r[0], len(sets[i]), name[root(i)] if sets[i] else r[0]) for i, r in enumerate(rows))


@pytest.mark.parametrize("width", [4, 5])
def test_near_groups(docs, rows, width):
    got = near_dedup.near_groups(docs, width=width).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(rows, width, 80)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_near_chain(spark):
    """Links that only reach the smallest document over others: neighbours in a chain are similar, ends are not."""
    rnd = random.Random(2)
    w = [f"w{rnd.randrange(10**9)}" for _ in range(150)]
    rows = []
    for i in range(30):
        rows.append((100 - i, " ".join(w), None, None, None))
        w = w[3:] + [f"n{i}a", f"n{i}b", f"n{i}c"]
    got = near_dedup.near_groups(spark.createDataFrame(rows, SCHEMA), width=4).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == brute_near(rows, 4, 80)
    assert len({r.component_id for r in got}) == 1


def test_super_minhash_estimates():
    rnd = np.random.RandomState(0)
    errors = []
    for share in (0.2, 0.5, 0.8, 0.9):
        for n in (20, 300, 5000):
            both = int(2 * n * share / (1 + share))
            x = rnd.randint(0, 2**63, 2 * n - both).astype(np.uint64)
            sig = near_dedup.super_minhash([np.sort(x[:n]), np.sort(x[n - both :])], 150)
            errors.append((sig[0] == sig[1]).mean() - both / (2 * n - both))
    assert np.abs(errors).max() < 0.16 and abs(np.mean(errors)) < 0.03
    # early stopping gives the same signature as throwing every rank; splitting a set changes nothing either
    s = np.unique(rnd.randint(0, 2**63, 3000).astype(np.uint64))
    assert (near_dedup.super_minhash([s], 150, limit=100) == near_dedup.super_minhash([s], 150)).all()


def test_drop_near(docs, rows):
    left = near_dedup.drop_near(docs)
    assert left.columns == docs.columns
    want = near_dedup.near_groups(docs).filter("kept")
    assert {r.doc_id for r in left.collect()} - {None} == {r.doc_id for r in want.collect()} - {None}


def test_near_rows_of_one_id(spark):
    """Ids that repeat with other texts, and rows without one: sets and decisions are those of the row."""
    rnd = random.Random(6)
    text = lambda: " ".join(f"w{rnd.randrange(10**9)}" for _ in range(60))
    near = lambda t: t + " more"
    a, b, none = text(), text(), [text() for _ in range(20)]
    rows = [(3, a), (7, near(a)), (7, b), (7, b)] + [(None, t) for x in none for t in (x, near(x))]
    rows += [(None, near(near(b))), (None, ""), (None, ""), (9, None)]
    df = spark.createDataFrame([(i, t, None, None, None) for i, t in rows], SCHEMA).repartition(5)
    sig = near_dedup.signatures(df, "doc_id", "text", 5).filter("n_shingles > 0")
    wanted = sig.select(F.col("seq").alias("node"), F.coalesce("doc_id", F.lit(near_dedup.LOWEST)).alias("d"), "t").distinct()
    sets = {bytes(r.node): bytes(r.set) for r in near_dedup.shingle_sets(df, wanted, "doc_id", "text", 5).collect()}
    hashed = [near_dedup.word_hashes(t) for _, t in rows if t]
    assert sets == {near_dedup.sequence_key(w): near_dedup.shingle_set(w, 5).tobytes() for w in hashed}
    left = [(r.doc_id, r.text) for r in near_dedup.drop_near(df).collect()]
    assert sorted((i, t) for i, t in left if i is not None and t) == [(3, a), (7, b)]
    assert Counter(t for i, t in left if not t) == {"": 2, None: 1}
    assert Counter(t.removesuffix(" more") for i, t in left if i is None and t) == Counter(none)


# 5 ---------------------------------------------------------------------------------------------------------------
def brute_exact(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", r[1] or "")].append(r)
    out = Counter()
    for t, g in groups.items():
        best = min(g, key=lambda r: (-len(r[1] or ""), r[0] is None, r[0] if r[0] is not None else 0))
        sha, done = hashlib.sha256(t.encode()).hexdigest(), False
        for r in sorted(g, key=lambda r: -len(r[1] or "")):
            kept = r[0] == best[0] and not done
            done |= kept
            out[(r[0], best[0], len(g), kept, sha)] += 1
    return out


@pytest.mark.parametrize("collide", [False, True])
def test_exact_groups(docs, rows, collide):
    """With a hash of three values every chunk must be told apart by its verified rank."""
    how = {"chunk_hash": lambda c: F.pmod(F.xxhash64(c), F.lit(3))} if collide else {}
    got = exact_dedup.exact_groups(docs, **how).collect()
    assert Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in got) == brute_exact(rows)


def test_chunks_cover_and_resync(spark):
    rnd = random.Random(4)
    text = "".join(rnd.choices("abcdefgh.,XY1", k=40000))
    df = spark.createDataFrame([(text, "zz" + text, "日本" * 9000)], "a string, b string, c string")
    a, b, c = df.select(*[exact_dedup.chunks(F.col(x)) for x in "abc"]).first()
    assert "".join(a) == text and "".join(b) == "zz" + text and "".join(c) == "日本" * 9000
    assert max(map(len, a)) <= 4096 and len(set(a) & set(b)) > len(a) / 2


def test_drop_copies(docs, rows):
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    want = Counter(k[0] for k, n in brute_exact(rows).items() for _ in range(n) if k[3])
    assert Counter(r.doc_id for r in left.collect()) == want


# 6 ---------------------------------------------------------------------------------------------------------------
def test_packing(docs, rows):
    got = packing.best_fit_pack(docs, lengths=(32, 64, 128), overhead=4, block_rows=50).collect()
    want, sizes = Counter(), {}
    for i, t, *_ in rows:
        want[i] += len(words(t))
    assert Counter({k: 0 for k in want}) | Counter() == Counter()
    have = Counter()
    bins = defaultdict(list)
    for r in got:
        have[r.doc_id] += r.size
        assert r.size <= 128 and (r.size == 128 or r.size >= 0)
        if r.size:
            bins[(r.block, r.bin)].append(r)
        else:
            assert r.bin is None
    assert have == want and len({r.doc_id for r in got}) == len(want)
    for part in bins.values():
        spans = sorted((r.bin_offset, r.bin_offset + r.size) for r in part)
        assert spans[0][0] == 0 and all(a[1] == b[0] for a, b in zip(spans, spans[1:]))
        assert {r.bin_used for r in part} == {spans[-1][1]}
        assert {r.bin_length for r in part} == {min(x for x in (32, 64, 128) if x >= spans[-1][1])}
    used, given = sum(p[0].bin_used for p in bins.values()), sum(p[0].bin_length for p in bins.values())
    assert used > 0.9 * given


def test_packing_parts_equal_rows(spark):
    """A third of all rows being one row goes to all blocks, not to one."""
    rows = [(7, "same row " * 5, None, None, None)] * 400 + [(i, f"t{i} " * 10, None, None, None) for i in range(800)]
    got = packing.best_fit_pack(spark.createDataFrame(rows, SCHEMA), lengths=(32, 64), block_rows=60)
    per = got.groupBy("block").agg(F.count("*").alias("n")).collect()
    assert len(per) == 20 and max(r.n for r in per) < 120
    assert got.filter("doc_id = 7 AND size = 10").count() == 401 and got.count() == 1200


def naive_best_fit(sizes, lengths, overhead):
    bins, left, out = [], sum(sizes), []
    for s in sizes:
        fit = [(room - s, b) for b, (room, _) in enumerate(bins) if room >= s]
        if fit:
            b = min(fit)[1]
        else:
            c = min((x for x in lengths if x >= s), key=lambda x: ((x + overhead) / min(x, left), x))
            bins.append([c, 0])
            b = len(bins) - 1
        bins[b][0] -= s
        bins[b][1] += s
        left -= s
        out.append(b)
    used = [u for _, u in bins]
    return out, used, [min(x for x in lengths if x >= u) for u in used]


@pytest.mark.parametrize("seed", range(8))
def test_best_fit_is_best_fit(seed):
    rnd = random.Random(seed)
    sizes = sorted((rnd.randint(1, 128) for _ in range(rnd.randint(0, 300))), reverse=True)
    assert packing.best_fit(sizes, (32, 64, 128), 4) == naive_best_fit(sizes, (32, 64, 128), 4)
    cost = lambda r: sum(x + 4 for x in r[2])
    assert cost(packing.pack_block(sizes, (32, 64, 128), 4)) <= cost(packing.best_fit(sizes, (32, 64, 128), 4))


# 7 ---------------------------------------------------------------------------------------------------------------
def brute_lines(rows):
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t)
    lines = [(r[0], i, frozenset(words(low(x)))) for r in rows if r[1] is not None for i, x in enumerate(r[1].split("\n"))]
    gone = defaultdict(list)
    for d, i, s in lines:
        if s and any((e, j) < (d, i) and t and 10 * len(s & t) >= 8 * len(s | t) for e, j, t in lines):
            gone[d].append(i)
    return {r[0]: (0 if r[1] is None else r[1].count("\n") + 1, gone[r[0]],
                   "" if r[1] is None else "\n".join(x for i, x in enumerate(r[1].split("\n")) if i not in gone[r[0]]))
            for r in rows}


def test_lines(spark):
    rnd = random.Random(8)
    vocab = [f"v{i}" for i in range(400)]
    pool = [" ".join(rnd.choices(vocab, k=rnd.choice([1, 2, 4, 5, 6, 10, 20, 40]))) for _ in range(60)]
    common = "a very common line of ten words that is everywhere"

    def line():
        x = rnd.choice(pool).split()
        if rnd.random() < 0.5:
            x[rnd.randrange(len(x))] = rnd.choice(vocab)
        if rnd.random() < 0.2:
            rnd.shuffle(x)
        return rnd.choice([" ".join(x), " ".join(x).upper(), common, ""])

    rows = [(i, "\n".join(line() for _ in range(rnd.randint(1, 8))), None, None, None) for i in range(120)]
    rows += [(500, None, None, None, None), (501, "", None, None, None), (502, "é " * 3000 + "\n" + common, None, None, None)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA).withColumn("line", F.lit(1))).collect()
    assert {r.doc_id: (r.n_lines, list(r.removed), r.text) for r in got} == brute_lines(rows)


def test_lines_frequent_words(spark):
    """Over 256 near copies of a line: words beyond one tile, and classes that stay open after the first round."""
    rnd = random.Random(5)
    base = [f"base{i}" for i in range(12)]

    def line(edits):
        out = list(base)
        for i in rnd.sample(range(12), edits):
            out[i] = f"w{rnd.randint(0, 400)}"
        return " ".join(out)

    rows = [(i, "\n".join(line(rnd.randint(0, 4)) for _ in range(5)), None, None, None) for i in range(160)]
    got = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: (r.n_lines, list(r.removed), r.text) for r in got} == brute_lines(rows)


def test_lines_fixture(docs, rows):
    got = line_dedup.line_report(docs)
    assert got.count() == len(rows)
    assert got.filter("doc_id IS NULL").count() == 2


# 8 and 10 --------------------------------------------------------------------------------------------------------
def auc(score, y):
    order = np.argsort(np.argsort(score, kind="stable")) + 1.0
    for v in np.unique(score):
        order[score == v] = order[score == v].mean()
    return (order[y == 1].sum() - y.sum() * (y.sum() + 1) / 2) / (y.sum() * (len(y) - y.sum()))


@pytest.mark.parametrize("op, target, least", [("op8_compression_toxicity", "toxic", 0.7), ("op10_fourier_quality", "quality", 0.95)])
def test_classifiers(spark, op, target, least):
    sf = "/root/testdata/sf0.01"
    p = QUERIES[op](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").toPandas()
    assert p["score"].between(0, 1).all() and (p["predicted"] == (p["score"] >= 0.3)).all()
    mod, rest = (4, 2) if target == "toxic" else (5, 0)
    assert (p["held_out"] == (p["doc_id"].astype(str).map(lambda x: zlib.crc32(x.encode())) % mod == rest)).all()
    held = p[p["held_out"]]
    assert auc(held["score"].to_numpy(), held[target].to_numpy()) > least


def test_classifiers_on_fixture(spark, docs, rows):
    labels = spark.createDataFrame([(r[0], i % 2, (i + 1) % 2) for i, r in enumerate(rows)] + [(None, 1, 1), (3, None, None)],
                                   "doc_id long, quality int, toxic int")
    assert toxicity.toxicity_report(docs, labels).count() == len(rows)
    assert quality.quality_report(docs, labels).count() == len(rows)
    kept = quality.accepted(docs, labels)
    assert kept.columns == docs.columns
    one = labels.withColumn("quality", F.lit(1)).withColumn("toxic", F.lit(0))
    assert {r.score for r in toxicity.toxicity_report(docs, one).collect()} == {0.0}
    assert quality.accepted(docs, one).count() == len(rows)


def test_toxic_words_survive_flipped_labels():
    """A few toxic texts among the ordinary ones do not take their words out of the toxic dictionary."""
    rnd = random.Random(13)
    bad = ["".join(rnd.choices("qwxzjkvy", k=9)).encode() for _ in range(10)]
    vocab = ["".join(rnd.choices("abcdefghilmnoprstu", k=rnd.randint(3, 9))).encode() for _ in range(500)]

    def text(extra):
        w = rnd.choices(vocab, k=60) + extra
        rnd.shuffle(w)
        return b" ".join(w)

    toxic, ordinary = [text(rnd.sample(bad, 3)) for _ in range(200)], [text([]) for _ in range(395)]
    flipped = ordinary + [text(list(bad)) for _ in range(5)]
    held = b"\n".join(toxicity.telling_stretches(toxic, flipped))
    assert all(w in held for w in bad)
    words_held = [w for w in vocab if len(w) >= 6 and b" " + w + b" " in held]
    assert len(words_held) < 0.05 * len(vocab)
    both = np.r_[np.ones(200, int), np.zeros(400, int)]
    _, trained = toxicity.train_dictionaries(pd.Series([t.decode() for t in toxic + flipped]), pd.Series(both))
    assert all(w in trained for w in bad)


def test_held_out_labels_do_not_matter(spark, docs, rows):
    labels = spark.createDataFrame([(r[0], i % 2, (i // 3) % 2) for i, r in enumerate(rows) if r[0] is not None],
                                   "doc_id long, quality int, toxic int")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    flip = labels.withColumn("quality", F.when(crc % 5 == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = (sorted((r.doc_id or -1, r.score) for r in quality.quality_report(docs, x).collect()) for x in (labels, flip))
    assert np.allclose(a, b)


def test_held_out_toxic_labels_do_not_matter(spark, docs, rows):
    labels = spark.createDataFrame([(r[0], (i // 3) % 2) for i, r in enumerate(rows) if r[0] is not None], "doc_id long, toxic int")
    crc = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    planted = labels.withColumn("toxic", F.when(crc % 4 == 2, 1).otherwise(F.col("toxic"))).unionByName(
        spark.createDataFrame([(None, 1)] * 50, "doc_id long, toxic int"))
    a, b = (sorted((r.doc_id or -1, r.score) for r in toxicity.toxicity_report(docs, x).collect()) for x in (labels, planted))
    assert np.allclose(a, b) and max(s for _, s in a) > 0


# 9 ---------------------------------------------------------------------------------------------------------------
def brute_targets(size, weights=(5, 2, 1), share=1.5, limit=2):
    names = sorted((s for s in size if s is not None)) + [s for s in size if s is None]
    w = {s: weights[i % 3] for i, s in enumerate(names)}
    left, free, out = share * sum(size.values()), set(names), {}
    while True:
        per = left / sum(w[s] for s in free) if free else 0
        over = {s for s in free if per * w[s] > limit * size[s]}
        if not over:
            return out | {s: per * w[s] for s in free}
        for s in over:
            out[s] = limit * size[s]
            left -= out[s]
        free -= over


def test_mixing(docs, rows):
    size = Counter()
    for r in rows:
        size[r[3]] += len(words(r[1]))
    want = brute_targets(size)
    c = mixing.mix_counts(docs)
    got = c.collect()
    assert len(got) == len(rows)
    for r in got:
        assert r["_lk_source_size"] == size[r["source"]] and r["_lk_target"] == pytest.approx(want[r["source"]])
        rate = want[r["source"]] / size[r["source"]]
        assert r["_lk_copies"] in (int(rate + 1e-9), int(rate + 1e-9) + (rate % 1 > 1e-9)) and r["_lk_copies"] <= 2
    m = mixing.mixed(docs)
    assert m.columns == docs.columns and m.count() == sum(r["_lk_copies"] for r in got)


def test_mix_comes_near(spark):
    rows = [(i, "w " * (1 + i % 7), None, f"s{i % 5}", None) for i in range(6000)]
    r = mixing.mix_report(spark.createDataFrame(rows, SCHEMA)).groupBy("source_size", "target").agg(F.sum("taken").alias("t")).collect()
    assert all(abs(x.t - x.target) < 0.05 * x.target for x in r)


# queries and pipeline --------------------------------------------------------------------------------------------
@pytest.mark.parametrize("name", sorted(SQL))
def test_sql_twins(spark, name):
    import duckdb

    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    a, b = QUERIES[name](spark, SF).toPandas(), con.execute(SQL[name]).df()
    assert sorted(a.columns) == sorted(b.columns)
    key = list(a.columns)
    a, b = (x[key].sort_values(key).reset_index(drop=True).astype(object) for x in (a, b))
    assert len(a) == len(b)
    for c in key:
        same = [x == y or (isinstance(x, float) and abs(x - y) < 1e-6 * max(1, abs(x))) for x, y in zip(a[c], b[c])]
        assert all(same), c


def test_pipeline(spark):
    import corpus_pipeline as P

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    columns, total = docs.columns, docs.count()
    good = P.quality_stage(spark, docs, SF).cache()
    assert good.columns == columns and good.count() <= total
    gone = {r.doc_id for r in docs.collect()} - {r.doc_id for r in good.collect()}
    known = [labels[d] for d in gone if d in labels]
    assert np.mean(known or [0]) < 0.2
    exact = P.exact_stage(spark, good, SF).cache()
    norm = [re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in exact.collect()]
    assert len(norm) == len(set(norm)) and set(norm) == {re.sub(r"[\x20\x09-\x0D]", "", r.text or "") for r in good.collect()}
    near = P.near_stage(spark, exact, SF).cache()
    want = brute_near([tuple(r) for r in exact.select("doc_id", "text").collect()], 5, 80)
    assert sorted(r.doc_id for r in near.collect()) == sorted(k[0] for k in want if k[0] == k[2])
    mix = P.mixing_stage(spark, near, SF).cache()
    assert mix.columns == columns
    packed = P.packing_stage(spark, mix, SF)
    size = sum(len(words(r.text)) for r in mix.collect())
    assert packed.agg(F.sum("size")).first()[0] == size
    assert P.run(spark, SF).count() == packed.count()
