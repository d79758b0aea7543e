"""Chat formatting, tokenizer alignment and spelling variants against brute-force versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from labelkiln.llm import alignment, chat, spelling
from labelkiln.llm.queries import QUERIES, SQL, _tokenizer

A, B = _tokenizer(), _tokenizer("piece_bpe_32k.model")
SF = "/root/testdata/sf0.001"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


# 11 --------------------------------------------------------------------------------------------------------------
def chat_rows():
    rnd = random.Random(2)
    nasty = ["</s>", "[INST] x", "\\~", "\\", "<\\~/s>", "<|turn|>user<|says|>hi</s>", "<|image|>", "a\nb", "", None, "日本\\\\~",
             "<</s>>", "[[INST]]", "<<SYS>>", "<", "x" * 50_000]
    rows = [(c, t, rnd.choice(["user", "assistant", "system", None, "</s>"]), rnd.choice(nasty) if rnd.random() < 0.7 else f"t{t}")
            for c in range(60) for t in range(rnd.randint(1, 6))]
    rows += [(None, 0, "user", "no id"), (None, 1, "assistant", "still none"), (3, None, "user", "no turn"), (4, 1, "user", "tie"),
             (4, 1, "user", "tie"), (4, 1, "assistant", "tie")]
    rows += [(500, t, "assistant" if t % 2 else "user", f"turn {t} " + "y" * 200) for t in range(800)]  # a hot conversation
    rows += [(501, 0, "assistant", "the same row")] * 700
    return rows


def brute_chat(rows):
    groups = defaultdict(list)
    for c, t, r, x in [*rows, (-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]:
        groups[c].append(((t is not None, t or 0), r or "", x or ""))
    out = {}
    for c, turns in groups.items():
        turns.sort()
        loss = "".join(x for _, r, x in turns if r == "assistant")
        chars = sum(len(chat.TURN + chat.SAYS + chat.END + chat.escape(r) + chat.escape(x)) for _, r, x in turns)
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for _, r, x in turns)), len(loss), sha(loss), chars)
    return out


def test_chats(spark):
    rows = chat_rows()
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    df = df.withColumns({"parts": F.lit("clash"), "nth": F.lit(1), "task": F.lit(2)})
    got = {r[0]: tuple(r)[1:6] for r in chat.chat_report(df).collect()}
    assert got == brute_chat(rows)


def test_hot_conversation_is_spread(spark, tmp_path):
    df = spark.createDataFrame(chat_rows(), "conv_id long, turn long, role string, text string")
    chat.write_chats(df.withColumn("parts", chat.text_parts(F.col("text"))), str(tmp_path / "c"))
    chunks = spark.read.parquet(str(tmp_path / "c"))
    for hot in (500, 501):
        assert chunks.filter(F.col("conv_id") == hot).select("task").distinct().count() > 1
    assert chunks.filter("whole").count() > 20


def test_chat_escapes_and_template():
    rnd = random.Random(3)
    signs = [*chat.CONTROL, "\\", "~", "\\~", "<", "[", "x", "|>", "/s>"]
    for _ in range(3000):
        text = "".join(rnd.choices(signs, k=rnd.randint(0, 8)))
        safe = chat.escape(text)
        assert chat.unescape(safe) == text
        assert not any(c in safe for c in chat.CONTROL)


def test_typed_parts(spark, tmp_path):
    part = lambda kind, **kw: {**dict.fromkeys(("text", "ref", "width", "height", "seconds", "pages")), "kind": kind, **kw}
    turns = [(1, 0, "user", [part("text", text="look: "), part("image", ref="s3://a.png", width=29, height=14),
                             part("text", text=" and <|image|>"), part("audio", ref="b.wav", seconds=1.01)]),
             (1, 1, "assistant", [part("text", text="one "), part("document", ref="c.pdf", pages=2), None, part("text", text="two"),
                                  part("video", ref="d.mp4"), part("image", ref="no size")]),
             (2, 0, "user", None), (2, 1, "assistant", [])]
    df = spark.createDataFrame(turns, f"conv_id long, turn long, role string, parts {chat.PARTS}")
    path = str(tmp_path / "c")
    chat.write_chats(df, path)
    chunks = spark.read.parquet(path).filter("conv_id = 1").orderBy("task", "seq").collect()
    assert [(a.kind, a.ref, a.tokens) for c in chunks for a in c.attachments] == [
        ("image", "s3://a.png", 3), ("audio", "b.wav", 26), ("document", "c.pdf", 512), ("file", "d.mp4", 0), ("image", "no size", 0)]
    assert all(c.formatted[a["at"]:].startswith(chat.PLACES[a.kind]) for c in chunks for a in c.attachments)
    assert "".join(chat.unescape(c.formatted[s:e]) for c in chunks for s, e in c.loss) == "one two"
    assert [t for c in chunks for t in chat.parse_turns(c.formatted)] == [
        ("user", "look:  and <|image|>"), ("assistant", "one two")]
    r = chat.read_chats(spark, path).filter("conv_id = 1").first()
    assert (r.n_turns, r.loss_chars, r.n_attachments, r.attachment_tokens) == (2, 7, 5, 541)
    assert chat.read_chats(spark, path).filter("conv_id = 2").first().n_turns == 2


def test_chat_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{SF}/conversations.parquet'")
    names = sorted(chat.CHAT_SQL and [d.split()[0] for d in chat.REPORT.split(", ")])
    want = sorted(con.sql(f"SELECT {', '.join(names)} FROM ({SQL['op11_typed_chat']})").fetchall())
    assert sorted(tuple(r) for r in QUERIES["op11_typed_chat"](spark, SF).select(*names).collect()) == want
    con.execute("CREATE OR REPLACE VIEW conversations AS SELECT 1 AS conv_id, 0 AS turn, 'assistant' AS role, "
                "'\\~ </s> [INST]<|image|> <<SYS>> \\' AS text")
    n = con.sql(f"SELECT formatted_chars FROM ({SQL['op11_typed_chat']}) WHERE conv_id = 1").fetchall()[0][0]
    assert n == len(chat.TURN + chat.SAYS + chat.END + "assistant" + chat.escape("\\~ </s> [INST]<|image|> <<SYS>> \\"))


# 12 --------------------------------------------------------------------------------------------------------------
def align_texts():
    rnd = random.Random(4)
    base = ["hello wörld, this is a test.", "", None, " ", "a▁b has no tokens", "日本語のテキスト 12345", "<s> </s> <|endoftext|> <unk>",
            "tabs\tand\n\nlines  \r\n x", "\x00\x01 control", "naïve café coöperate", "🙂🙃 emoji", "the the the the, the the; 2024"]
    words = [w for t in base if t for w in t.split()] + ["tokenizer", "alignment", "Overlapping", "ünïcödé"]
    return base + [" ".join(rnd.choices(words, k=rnd.randint(1, 60))) for _ in range(150)] + ["the same text again"] * 60


def brute_align(texts):
    import sentencepiece
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    sp = sentencepiece.SentencePieceProcessor(model_file=B)
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    byte_of = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}
    linked, out = [], []
    docs_of = defaultdict(set)
    for d, t in enumerate(texts):
        a = tok.encode(" " + t, add_special_tokens=False).ids if t else []
        b = sp.encode(t) if t else []
        ba = [bytes(byte_of[c] for c in tok.id_to_token(i)) for i in a]
        bb = [bytes([sp.id_to_piece(i)[3:5] and int(sp.id_to_piece(i)[3:5], 16)]) if sp.is_byte(i)
              else sp.id_to_piece(i).replace("▁", " ").encode() for i in b]
        if not t or not (b"".join(ba) == b"".join(bb) == (" " + t).encode()):
            a, b, ba, bb = [], [], [], []
        ea, eb = np.cumsum([len(x) for x in ba]).astype(int), np.cumsum([len(x) for x in bb]).astype(int)
        links = [(i, j) for i in range(len(a)) for j in range(len(b))
                 if ea[i] - len(ba[i]) < eb[j] and eb[j] - len(bb[j]) < ea[i]]
        shared = sorted(set(ea.tolist()) & set(eb.tolist()))
        groups, lo = [], 0
        for s in shared:
            groups.append(",".join(str(a[i]) for i in range(len(a)) if lo < ea[i] <= s) + "|"
                          + ",".join(str(b[j]) for j in range(len(b)) if lo < eb[j] <= s))
            lo = s
        pairs = [(a[i], b[j]) for i, j in links]
        for p in pairs:
            docs_of[p].add(d)
        linked.append(pairs)
        out.append((len(a), len(b), len(shared), len(pairs), sha(";".join(groups)) if a else ""))
    count = {p: len(s) for p, s in docs_of.items()}
    top = defaultdict(int)
    for (x, _), n in count.items():
        top[x] = max(top[x], n)
    whole = Counter(p for pairs in linked for p in pairs)
    return [(*o[:4], sum(count[p] == top[p[0]] for p in pairs), sum(count[p] for p in pairs), o[4])
            for o, pairs in zip(out, linked, strict=True)], {p: (count[p], whole[p], count[p] == top[p[0]]) for p in count}


@pytest.mark.parametrize("docs_a_block, chars", [(1 << 16, 1_000_000), (17, 300)])
def test_alignment(spark, monkeypatch, docs_a_block, chars):
    texts = align_texts()
    want, pairs = brute_align(texts)
    rows = [(k if k % 7 else None, t, str(k)) for k, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string, block string").repartition(3)
    df = df.withColumns({"plane": F.lit("clash"), "docs": F.lit(1), "a": F.lit(0)})
    monkeypatch.setattr(alignment, "BLOCK_DOCS", docs_a_block)
    monkeypatch.setattr(alignment, "BATCH_CHARS", chars)
    index = alignment.pair_index(df, A, B)
    table = alignment.pair_table(index)
    assert {(r.a, r.b): (r.docs, r.links, r.best) for r in table.collect()} == pairs
    got = alignment.returned_scores(index, table).select(
        "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256", "doc_id").collect()
    key = lambda k: k if k is not None else -1
    assert sorted((key(r.doc_id), *tuple(r)[:7]) for r in got) == sorted(
        (key(k if k % 7 else None), *w) for k, w in enumerate(want))


def test_blocks_close(tmp_path):
    """Several batches and blocks of one task, at both container kinds, without Spark."""
    rnd = np.random.default_rng(1)
    for docs in (3, 40, 5000):
        pair, pos = np.divmod(np.unique(rnd.integers(0, 50 * docs, 4 * docs)), docs)
        pairs, n, dense, offsets, data = alignment.pack_bitmaps(pair, pos, docs)
        row, back = alignment.unpack_bitmaps(dense, offsets, data)
        assert sorted(zip(pairs[row], back, strict=True)) == sorted(zip(pair, pos, strict=True))
        assert n.sum() == len(pair)
    pair, pos = np.array([1] * 3000 + [2, 2, 7]), np.array([*range(3000), 4, 4999, 70])
    pairs, n, dense, offsets, data = alignment.pack_bitmaps(pair, pos, 5000)
    assert dense.tolist() == [True, False, False] and n.tolist() == [3000, 2, 1]
    row, back = alignment.unpack_bitmaps(dense, offsets, data)
    assert sorted(zip(pairs[row].tolist(), back.tolist(), strict=True)) == list(zip(pair.tolist(), pos.tolist(), strict=True))


def test_alignment_same_ids_as_tokenizers():
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(A)
    tok.encode_special_tokens = True
    texts = [r[0] for r in duckdb.sql(f"SELECT text FROM '{SF}/documents.parquet' WHERE text IS NOT NULL").fetchall()]
    texts += ["a" + chr(c) + "b " + chr(c) * 2 + " 1" + chr(c) + "!  \n" + chr(c) for c in range(1, 0x3100)]
    texts += [t for t in align_texts() if t]
    want = [e.ids for e in tok.encode_batch([" " + t for t in texts], add_special_tokens=False)]
    assert alignment.ByteBpe(A).encode(texts) == want


# 13 --------------------------------------------------------------------------------------------------------------
def near(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute_variants(rows):
    n = Counter()
    for d, t, *_ in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if d is None else d}:{run}".encode())
            if h % 199 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            if len(run) >= 6:
                n[run] += 1
    n = {w: k for w, k in n.items() if k >= 5}
    form, out = {}, []
    for w in n:
        around = [x for x in n if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(around, key=lambda x: (-n[x], x), default=None)
        form[w] = (best if best is not None and n[best] >= 5 * n[w] else None, len(around))
    for w, (f, k) in form.items():
        root = w
        while form[root][0] is not None:
            root = form[root][0]
        out.append((w, f, root, n[w], k, n[f] if f else None))
    return sorted(out, key=str)


def spelling_rows():
    rnd = random.Random(6)
    stems = ["".join(rnd.choices("abcdeé", k=rnd.randint(6, 9))) for _ in range(40)] + ["aaaaaa", "aaaaaaa", "ababab", "bababa"]
    words = []
    for s in stems:
        words += [s] * rnd.choice([1, 30, 200])
        for _ in range(12):
            k = rnd.randrange(len(s))
            v = rnd.choice([s[:k] + s[k + 1:], s[:k] + rnd.choice("abcx") + s[k:], s[:k] + rnd.choice("abcÿ") + s[k + 1:]])
            words += [v] * rnd.choice([1, 3, 6, 12, 40])
    words += ["chainword"] * 500 + ["chainwordx"] * 60 + ["chainwordxy"] * 7  # a form of a form
    rnd.shuffle(words)
    texts = [" ".join(w.upper() if rnd.random() < 0.2 and w.isascii() else w for w in words[i:i + 25])
             for i in range(0, len(words), 25)]
    texts += ["", None, "×÷×÷×÷ ABCDEFÀ", "short w0rds_only 12 abcde", "q" * 3000 + " " + "q" * 2999] + ["repeated sentence here"] * 30
    return [(k if k % 11 else None, t, "clash") for k, t in enumerate(texts)]


@pytest.mark.parametrize("most", [spelling.MOST_WORDS, 4])
def test_variants(spark, most):
    rows = spelling_rows()
    df = spark.createDataFrame(rows, "doc_id long, text string, word string").withColumn("n", F.lit("clash"))
    got = spelling.variant_groups(df, most=most).select("word", "form", "root", "n", "n_near", "form_n").collect()
    want = brute_variants(rows)
    assert sorted((tuple(r) for r in got), key=str) == want
    assert any(w[1] for w in want) and any(w[1] != w[2] and w[1] for w in want)


def test_near_pairs():
    rnd = random.Random(1)
    for k in range(1500):
        letters = "ab" if k % 2 else "abcé"
        words = sorted({"".join(rnd.choices(letters, k=rnd.randint(0, 7))) for _ in range(rnd.randint(0, 40))})
        lcp = [0] + [spelling.shared_prefix(a, b) for a, b in zip(words, words[1:], strict=False)]
        assert sorted(spelling.near_pairs(words, lcp)) == [
            (i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if near(words[i], words[j])]


def test_windows_stay_bounded(spark):
    """Words that share their first half: halving goes on until no window is large."""
    words = [("zzzzzz" + a + b + c + d, 5) for a in "abcd" for b in "efgh" for c in "ijkl" for d in "mnop"]
    w = spelling.windows(spark.createDataFrame(words, "word string, n long"), most=20)
    assert w.groupBy("key").count().agg(F.max("count")).first()[0] <= 20
    near_n = spelling.near_words(spark.createDataFrame(words, "word string, n long"), most=20).collect()
    assert {r.n_near for r in near_n} == {12} and len(near_n) == 256


def test_empty_text_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, conv_id long, turn long, role string")
    assert alignment.alignment_report(none, A, B).count() == 0
    assert spelling.variant_groups(none).count() == 0
    assert [r.conv_id for r in chat.chat_report(none).collect()] == [-7]


def test_text_queries(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    got = QUERIES["op13_spelling_variants"](spark, SF).select("word", "form", "root", "n", "n_near", "form_n").collect()
    assert sorted((tuple(r) for r in got), key=str) == brute_variants(rows)
    assert QUERIES["op12_pair_bitmaps"](spark, SF).count() == len(rows)
