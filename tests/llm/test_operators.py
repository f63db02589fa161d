"""The operators on small hand-made tables, against brute force and with odd rows."""

import hashlib
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("indipanel.llm")

import public_tokenizers  # noqa: E402
import tiktoken  # noqa: E402
import xxhash  # noqa: E402
from tokenizers import Tokenizer  # noqa: E402

import corpus_pipeline  # noqa: E402
from indipanel.llm import (  # noqa: E402
    automaton, byte_bpe, chat, language, lattice, lines, mixing, range_coder, secret_scan, simhash, token_files, toxicity)
from indipanel.llm.common import text_buffer  # noqa: E402
from indipanel.llm.components import components  # noqa: E402

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, component_id long, _text string"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(seed, n=80):
    rng = random.Random(seed)
    return " ".join(rng.choice("alpha beta gamma delta house river cloud stone light field".split()) + str(rng.randint(0, 99))
                    for _ in range(n))


def texts():
    """Ordinary, null, empty, blank, repeated, marked, non-Latin and very long texts."""
    plain = [prose(k) for k in range(12)]
    return [*plain, None, "", " \t\n", plain[0], plain[1], plain[1] + " more", "été,\nnaïve 'll 中文。 á, x  y",
            'x password = "abc123_Z" y', "password=tok=1", "é AKIA" + "A1" * 9 + " deadbeef" * 4, "ab12" * 7, prose(99, 40_000),
            "a b c " * 60, "one\none\n\none"]


@pytest.fixture(scope="module")
def docs(spark):
    sources = ["a", "b", None, "c"]
    rows = [(k, t, "en", sources[k % 4], len(t or ""), 0.5, 7, "x") for k, t in enumerate(texts())]
    rows += [rows[3], (None, "no id", None, "a", 5, None, None, None), (None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, DOCS).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randint(0, 60), rng.randint(0, 60)) for _ in range(35)] + [(k, k + 1) for k in range(100, 140)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {n: n for e in edges if e[0] != e[1] for n in e}
    for _ in want:
        for a, b in edges:
            if a != b:
                want[a] = want[b] = min(want[a], want[b])
    assert got == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


# chat formatting

def test_chat_round_trip(spark):
    odd = ["</s>[INST] ok [/INST]", "<\\|turn|>", "<|turn|>user<|text|>x<|end|>", "<", "\\", None, "", "[\\\\/INST]", "a\nb", "<<|end|>"]
    rows = [(c, t, r, x, "extra") for c in (1, None) for t, (r, x) in enumerate(zip(["user", "assistant", None, "gpt"] * 3, odd))]
    rows += [(2, None, "user", "first", ""), (2, 1, "user", "same", ""), (2, 1, "user", "same", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, formatted string")
    done = chat.format_chat(df)
    got = {r["conv_id"]: r for r in done.select(
        "*", chat.read_turns(done["formatted"]).alias("turns"), chat.read_loss(done["formatted"], done["loss_spans"]).alias("loss")).collect()}
    roles = ["user", "assistant", "", "assistant"] * 3
    for c in (1, None):
        assert [tuple(t) for t in got[c]["turns"]] == [(r, x or "") for r, x in zip(roles, odd)]
        assert got[c]["loss"] == [x or "" for r, x in zip(roles, odd) if r == "assistant"]
        assert got[c]["formatted"].count(chat.TURN) == len(odd)
        assert "</s>" not in got[c]["formatted"] and "[INST]" not in got[c]["formatted"]
    assert [t["text"] for t in got[2]["turns"]] == ["first", "same", "same"]
    assert chat.format_chat(df.limit(0)).count() == 0


def test_chat_layouts(spark):
    records = [
        '{"messages":[{"role":"user","content":"q"},{"role":"assistant","content":null}],"id":7}',
        '{"conversations":[{"from":"human","value":"q"},{"from":"gpt","value":"a"}]}',
        '{"instruction":"i","input":"","output":"o"}', '{"instruction":"i","input":"x","output":"o"}',
        '{"prompt":"p","completion":"c"}', '{"question":"q","answer":"a","source":"s"}', '{"other":1}', "no json", None, '{"messages":[]}']
    got = {r["conv_id"]: (r["layout"], r["turns"] and [tuple(t) for t in r["turns"]]) for r in chat.canonical_records(
        spark.createDataFrame(list(enumerate(records)), "conv_id long, record string")).collect()}
    assert got[0] == ("messages", [("user", "q"), ("assistant", "")])
    assert got[1] == ("from_value", [("user", "q"), ("assistant", "a")])
    assert got[2] == ("instruction_input", [("user", "i"), ("assistant", "o")])
    assert got[3] == ("instruction_input", [("user", "i\nx"), ("assistant", "o")])
    assert got[4] == ("prompt_completion", [("user", "p"), ("assistant", "c")])
    assert got[5] == ("question_answer", [("user", "q"), ("assistant", "a")])
    assert all(got[k] == (None, None) for k in range(6, 10))
    nested = spark.createDataFrame([(1, [("user", "q")])], "conv_id long, messages array<struct<role:string,content:string>>")
    assert [tuple(t) for t in chat.canonical(nested).first()["turns"]] == [("user", "q")]
    with pytest.raises(ValueError):
        chat.canonical(spark.range(1))


# mixing

def brute_targets(sizes, weights=(1, 2, 3), most=3.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    full, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(most * sizes[s] for s in full)
        open_ = [s for s in names if s not in full]
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > most * sizes[s]]
        if not over:
            return {**{s: most * sizes[s] for s in full}, **share}
        full |= set(over)


def test_mixing(spark, docs, empty):
    rng = random.Random(2)
    rows = [(k, " ".join(["w"] * rng.randint(0, 60)), rng.choice(["a", "b", "c", None]), 1) for k in range(900)]
    rows += [(k, "w w", "tiny", 1) for k in range(900, 905)] + [rows[0], (None, None, "a", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken long")
    got = mixing.mix(df, chunk=50).collect()
    assert sorted(map(tuple, mixing.mix(df.repartition(5), chunk=50).collect()), key=str) == sorted(map(tuple, got), key=str)
    sizes = {}
    for r in got:
        sizes[r["source"]] = sizes.get(r["source"], 0) + r["size"]
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    want = brute_targets(sizes)
    for s, total in sizes.items():
        mine = [r for r in got if r["source"] == s]
        assert mine[0]["target"] == pytest.approx(want[s]) and mine[0]["source_size"] == total
        assert abs(sum(r["taken"] for r in mine) - want[s]) <= max(2, 0.01 * want[s])
    assert len(got) == len(rows) and sum(want.values()) == pytest.approx(sum(sizes.values()))
    assert mixing.mix(empty).count() == 0 and mixing.mix(docs).count() == docs.count()
    copies = {r["doc_id"]: r["copies"] for r in got}
    out = mixing.mixed_documents(df.filter("doc_id > 0"))
    assert out.columns == df.columns and out.count() > 0 and max(copies.values()) <= 3


def test_flight_keeps_totals():
    rng = random.Random(3)
    p, x = [rng.random() for _ in range(200)], [float(rng.randint(1, 50)) for _ in range(200)]
    y, before = [1.0] * 200, list(p)
    rest = mixing.flight(list(range(200)), p, x, y, rng)
    assert len(rest) <= 2 and all(p[k] in (0, 1) for k in range(200) if k not in rest)
    assert sum(a * b for a, b in zip(p, x)) == pytest.approx(sum(a * b for a, b in zip(before, x)))
    assert sum(p) == pytest.approx(sum(before))


# SimHash

def brute_fingerprint(text):
    words = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)] * bool(words)
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute_components(fps, bits):
    least = {f: f for f in fps}
    for _ in fps:
        changed = False
        for a in fps:
            for b in fps:
                if (a ^ b).bit_count() <= bits and least[b] < least[a]:
                    least[a], changed = least[b], True
        if not changed:
            return least


@pytest.mark.parametrize("bits, bucket", [(2, 256), (2, 1), (3, 1), (1, 256), (0, 256)])
def test_close_pairs(spark, bits, bucket):
    rng = random.Random(4)
    base = [rng.getrandbits(63) for _ in range(6)]
    fps = {b ^ sum(1 << i for i in rng.sample(range(63), rng.randint(0, 4))) for b in base for _ in range(12)}
    pairs = simhash.close_pairs(spark.createDataFrame([(f,) for f in fps], "fp long"), bits, 7, bucket)
    got = {r["node"]: r["component"] for r in components(pairs).collect()}
    want = brute_components(sorted(fps), bits)
    assert {f: got.get(f, f) for f in fps} == want


def test_simhash(docs, empty):
    rows = docs.select("doc_id", "text").collect()
    got = simhash.near_duplicates(docs).collect()
    prints = {(r["doc_id"], r["fingerprint"]) for r in got}
    assert prints == {(r["doc_id"], f"{brute_fingerprint(r['text']):016x}") for r in rows} and len(got) == len(rows)
    found = {r["doc_id"]: r["component_id"] for r in got if r["doc_id"] is not None}
    assert found[15] == 0 and found[16] == 1 and found[13] == found[14] == 12
    kept = simhash.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert len(ids) == len(set(ids)) and {0, 1, 3, 12} <= set(ids) and not {13, 14, 15, 16} & set(ids)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.without_near_duplicates(empty).count() == 0


# secrets

def test_automaton_like_regex():
    rng = random.Random(5)
    rules = [(r"a[b-c]+d?", False), (r"(x|yy){2,3}", True), (r"[^ab]b", False)]
    starts, ends = automaton.compile_rules(rules, anywhere=True, backwards=True), [automaton.compile_rules([r]) for r in rules]
    for n in (0, 1, 30, 3000):
        text = "".join(rng.choice("abcdxXyY \n") for _ in range(n)).encode()
        at, bits = automaton.accepted_positions(starts, np.frombuffer(text, np.uint8), lanes=16)
        for i, (rule, fold) in enumerate(rules):
            pattern = re.compile(rule.encode(), re.I if fold else 0)
            assert [p for p, b in zip(at, bits) if b >> i & 1] == [p for p in range(n) if pattern.match(text, p)]
            for p in range(min(n, 200)):
                m = pattern.match(text, p)
                assert automaton.longest_match(ends[i], text, p) == (m.end() if m else -1)


def test_secrets(docs, empty):
    got = by_id(secret_scan.find_secrets(docs))
    assert [tuple(s) for s in got[19]["secrets"]] == [("assign", 2, 22)]
    assert got[20]["secrets"] == []
    assert [tuple(s) for s in got[21]["secrets"]] == [("access", 2, 24)]
    assert [tuple(s) for s in got[22]["secrets"]] == [("hex", 0, 28)]
    assert got[12]["secrets"] == [] and got[23]["secrets"] == []
    clean = secret_scan.redacted(docs)
    out = by_id(clean)
    assert clean.columns == docs.columns and out[19]["text"] == 'x [SECRET]" y' and out[19]["n_chars"] == 13
    assert out[12]["text"] is None and out[0]["text"] == texts()[0]
    assert secret_scan.find_secrets(empty).count() == 0


# languages

def test_language(spark, empty):
    rng = random.Random(6)
    words = {"xx": "ka lo mi ne pu".split(), "yy": "sch ert ung ich ein".split()}

    def say(lang, n):
        return " ".join("".join(rng.choice(words[lang]) for _ in range(3)) for _ in range(n))

    rows = [(k, say(lang := ("xx", "yy")[k % 2], 60), lang) for k in range(200)]
    train = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.fit(train)
    both = say("xx", 100) + "\n" + say("yy", 40)
    odd = [(0, say("yy", 30), "xx"), (1, None, "xx"), (2, "", None), (3, "12 34!", None), (4, both, None), (4, both, None), (None, say("xx", 9), None)]
    got = language.predict(spark.createDataFrame(odd, "doc_id long, text string, lang_pred string"), model).collect()
    by = {r["doc_id"]: r for r in got}
    assert by[0]["lang_pred"] == "yy" and by[None]["lang_pred"] == "xx" and len(got) == len(odd)
    assert [by[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and by[3]["score"] == 0
    shares = dict(map(tuple, by[4]["languages"]))
    assert shares["xx"] == pytest.approx(100 / 140, abs=0.08) and set(shares) == {"xx", "yy"}
    none = language.fit(empty)
    assert {r["lang_pred"] for r in language.predict(train, none).collect()} == {"und"}
    assert language.predict(empty, model).count() == 0


# byte-level BPE

def test_byte_bpe(docs, empty):
    ranks = byte_bpe.read_ranks(public_tokenizers.path(byte_bpe.RANKS))
    like = tiktoken.Encoding("like", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    coded = byte_bpe.encode(docs, with_offsets=True)
    got = {r["doc_id"]: r for r in coded.collect()}
    for k, text in enumerate(texts()):
        ids = np.frombuffer(got[k]["ids"], "<u4").tolist()
        assert ids == like.encode_ordinary(text or "") and got[k]["decoded"] == (text or "").encode()
        assert len(got[k]["starts"]) == len(got[k]["ends"]) == len(ids)
    ids, text = np.frombuffer(got[18]["ids"], "<u4").tolist(), texts()[18]
    assert got[18]["ends"][-1] == len(text)
    for i, a, b in zip(ids, got[18]["starts"], got[18]["ends"]):
        assert like.decode_single_token_bytes(i) in text[a:b].encode()
    assert {r["doc_id"]: r["decoded"] for r in byte_bpe.decode(coded).collect()} == {k: r["decoded"] for k, r in got.items()}
    table = byte_bpe.ByteTable(Tokenizer.from_str(byte_bpe.tokenizer_json(ranks, public_tokenizers.PATTERN)).get_vocab())
    assert "".join(table.stream(ids)) == text
    assert byte_bpe.encode(empty).count() == 0


# toxicity

def test_nearest_is_exact():
    rng = np.random.default_rng(7)
    rows = []
    for _ in range(500):
        ids = np.sort(rng.choice(80, rng.integers(1, 20), replace=False))
        w = rng.random(len(ids))
        rows.append((ids, w / np.sqrt((w * w).sum())))
    rows[5] = rows[4]
    index = toxicity.Index.of(rows, 80)
    dense = np.zeros((500, 80))
    for k, (ids, w) in enumerate(rows):
        dense[k, ids] = w
    for k in range(0, 500, 7):
        near, cosines = index.nearest(*rows[k], 9)
        want = dense @ dense[k]
        np.testing.assert_allclose(cosines, np.sort(want)[::-1][:9], atol=1e-12)
        np.testing.assert_allclose(want[near], cosines, atol=1e-12)


def test_toxicity(spark, docs, empty):
    rows = [(k, prose(k, 40) + (" nasty vile" * 2 if k % 4 == 0 else ""), k % 4 == 0) for k in range(400)]
    df = spark.createDataFrame([(k, t) for k, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(v)) for k, _, v in rows] + [(3, None), (None, 1), (999, 1)], "doc_id long, toxic int")
    model = toxicity.fit(df, labels)
    got = by_id(toxicity.score(df, model))
    unseen = [k for k, _, _ in rows if zlib.crc32(str(k).encode()) % 5 == 0]
    assert np.mean([got[k]["predicted"] == int(rows[k][2]) for k in unseen]) > 0.97
    odd = toxicity.score(docs, model).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    kept = toxicity.without_toxic(docs, labels.limit(0))
    assert kept.columns == docs.columns and kept.count() in (0, docs.count())
    assert toxicity.score(empty, model).count() == 0


# lattice

def test_e8_decoding():
    rng = np.random.default_rng(8)
    steps = lattice.minimal_vectors()
    assert len(np.unique(steps, axis=0)) == 240 and ((steps ** 2).sum(1) == 8).all()
    x = rng.normal(size=(300, 8)) * 3
    point = lattice.nearest_e8(x)
    gap = ((2 * x - point) ** 2).sum(1)
    assert (gap <= ((2 * x[:, None] - point[:, None] - steps) ** 2).sum(2).min(1) + 1e-9).all()
    assert (gap / 4 <= 1 + 1e-9).all()  # the covering radius of E8 is 1


def test_lattice_links(spark):
    rng = np.random.default_rng(9)
    base = rng.normal(size=(20, 16))
    x = np.concatenate([base + rng.normal(size=(20, 16)) * s for s in (0, 0.02, 0.1, 0.2)] + [np.tile(base[:1], (30, 1))])
    rows = [(k, v.tolist(), "l") for k, v in enumerate(x)]
    n = len(rows)
    rows += [(n, None, ""), (n + 1, [0.0] * 16, ""), (n + 2, [None] + [1.0] * 15, ""), (n + 3, [float("nan")] * 16, ""), (n + 4, [1.0], "")]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links string")
    got = {r["vec_id"]: r for r in lattice.near_duplicates(df, tables=12, tile=8).collect()}
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    close = unit @ unit.T >= 0.9
    np.fill_diagonal(close, False)
    assert [got[k]["n_links"] for k in range(n)] == close.sum(1).tolist()
    root = list(range(n))
    for _ in range(n):
        root = [min([root[k], *[root[j] for j in np.flatnonzero(close[k])]]) for k in range(n)]
    assert [got[k]["component_id"] for k in range(n)] == root
    assert all(got[k]["n_links"] == 0 and got[k]["kept"] for k in range(n, n + 5))
    assert lattice.near_duplicates(df.limit(0)).count() == 0


# lines

def test_viterbi_is_best():
    rng = np.random.default_rng(10)
    field = lines.Field(rng.normal(size=lines.N_FEATURES), rng.normal(size=(2, 2)), rng.normal(size=2))
    for n in (1, 2, 6):
        f = rng.random((n, lines.N_FEATURES))

        def total(labels):
            s = field.begin[labels[0]] + sum(f[k] @ field.emit * labels[k] for k in range(n))
            return s + sum(field.move[a, b] for a, b in zip(labels, labels[1:]))

        best = max(total([m >> k & 1 for k in range(n)]) for m in range(1 << n))
        assert total(field.viterbi(f).tolist()) == pytest.approx(best)


def test_line_quality(spark, docs, empty):
    rows = [(k, "\n".join(prose(k * 10 + j, 12) for j in range(6)) if k % 3 else "\n".join("### $$ %% " * 3 for _ in range(6)) + f" {k}")
            for k in range(150)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, int(k % 3 > 0)) for k in range(150)] + [(1, None), (None, 0)], "doc_id long, quality int")
    field = lines.fit(df, labels)
    got = by_id(lines.judge(df, field))
    assert all((got[k]["content_share"] > 0.5) == (k % 3 > 0) for k in range(150))
    odd = lines.judge(docs, field).collect()
    for r in odd:
        text = texts()[r["doc_id"]] if r["doc_id"] is not None else None
        if text is None:
            continue
        words = WORD.findall(text)
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        counts = {w: windows.count(w) for w in set(windows)} if len(words) < 1000 else {}
        inside = {i + d for i, w in enumerate(windows) if counts.get(w, 0) > 1 for d in range(3)}
        assert (r["n_words"], r["word_chars"]) == (len(words), sum(map(len, words)))
        assert r["n_symbols"] == sum(c in "#*$%&|<>" for c in text)
        if counts or len(words) < 3:
            assert r["n_repeat_words"] == len(inside)
    assert by_id(lines.judge(docs.filter("doc_id = 25"), field))[25]["n_dup_lines"] == 2
    assert lines.judge(empty, field).count() == 0
    assert lines.train([]).emit[0] == 1


# token files

def test_range_coder_round_trip():
    rng = np.random.default_rng(11)
    blocks = [rng.zipf(1.3, n).clip(0, 49407).astype(np.uint32) for n in (0, 1, 5, 700, 4096)]
    blocks += [np.tile(np.arange(7, dtype=np.uint32), 300), np.full(1000, 49407, np.uint32)]
    codes = range_coder.encode_blocks(blocks, 49407)
    assert all((a == b).all() for a, b in zip(blocks, range_coder.decode_blocks(codes, [len(b) for b in blocks], 49407)))
    assert len(codes[5]) < 2100 / 2


def test_token_files(docs, empty):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(token_files.VOCABULARY))
    blocks = token_files.write_token_files(docs)
    got = token_files.read_token_files(blocks).collect()
    rows = sorted(((r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()),
                  key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at, want = 0, []
    for doc_id, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        at += len(ids)
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want
    damaged = bytearray(blocks.first()["payload"])
    damaged[-9] ^= 1
    with pytest.raises(ValueError):
        token_files.unpack([bytes(damaged)])
    assert token_files.read_token_files(token_files.write_token_files(empty)).count() == 0


# pipeline

def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    spark.createDataFrame([(k, 0, 0) for k in range(8)], "doc_id long, quality int, toxic int").write.parquet(str(tmp_path / "labels.parquet"))
    rows = spark.read.parquet(str(tmp_path / "documents.parquet"))
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, rows, str(tmp_path))
        assert out.columns == rows.columns, name
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    by = {r["doc_id"]: r for r in got}
    assert 0 in by or len(got) > 0
    for r in got:
        assert r["n_tokens"] * 4 == len(r["ids"]) and re.fullmatch("[0-9a-f]{64}", r["decoded_sha256"])
    if 0 in by:
        assert by[0]["decoded_sha256"] == hashlib.sha256(texts()[0].encode()).hexdigest()


def test_text_buffer():
    data, bounds = text_buffer(pa.array(["é", None, "", "ab"]).slice(1))
    assert bytes(data) == b"ab" and bounds.tolist() == [0, 0, 0, 2]
