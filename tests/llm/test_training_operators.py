"""Operators of the llm subpackage against plain models on small tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidemark.llm import mixing, near_duplicates, near_vectors, packing, personal_data, quality_model, quality_rules, token_counts, token_output, toxicity
from tidemark.llm.components import components
from tidemark.llm.shared import MemoEncoder

DOC = "doc_id long, text string, lang string, source string, n_chars long, extra string, copies int"
VOCABULARY = "the of and river stone walks under bright seven maps hold quiet engines near copper hills while rain falls slowly on old roofs again".split()


def docs(spark, texts, langs=None, sources=None, ids=None):
    n = len(texts)
    rows = [(ids[i] if ids else i, t, (langs or ["en"] * n)[i], (sources or ["s"] * n)[i], len(t or ""), "x", 9) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOC)


def prose(rng, n):
    return " ".join(rng.choice(VOCABULARY) for _ in range(n))


EDGES = [None, "", " \n\t ", "one", "a b c d", "word " * 3000, "x" * 30_000, "é \x1c ü   漢字 \U0001f600", "<|endoftext|> a <|startoftext|>", "same text again", "same text again"]


# ---- packing, token output, token counts


def test_packing_keeps_every_id_once(spark):
    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(1)
    texts = EDGES + [prose(rng, rng.choice([1, 30, 300, 5000])) for _ in range(60)]
    d = docs(spark, texts).repartition(3)
    rows = packing.pack(d, path).collect()
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(path)
    want = {i: [*library.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    got, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        got[r["doc_id"]].append((r["start"], np.frombuffer(bytes(r["ids"]), "<u4").tolist()))
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert r["doc_tokens"] == len(want[r["doc_id"]]) and r["length"] == len(r["ids"]) // 4 > 0
    assert {i: [x for _, p in sorted(v) for x in p] for i, v in got.items()} == want
    for s in sequences.values():
        s.sort()
        total = 0
        for offset, length in s:
            assert offset == total
            total += length
        assert total == 2048 or total & (total - 1) == 0  # no padding at all
    assert packing.pack(docs(spark, []), path).count() == 0


def test_encoder_like_the_library():
    path = public_tokenizers.path("byte_bpe_50k.json")
    code = MemoEncoder(path, bound=50)
    rng = random.Random(2)
    for t in [t for t in EDGES if t] + ["it's we'll  2024½ x²\xa0\x85 \r\n\n  end  ", *(prose(rng, 50) for _ in range(20))]:
        assert np.frombuffer(code.encode(t), "<u4").tolist() == code.tokenizer.encode(t, add_special_tokens=False).ids


def test_prefix_counts_like_the_library(spark):
    path = public_tokenizers.path("word_bpe_49k.json")
    c = token_counts.counter(path)
    texts = ["Hello, IT'S the they're 'tis!! 12", "naïve Straße ÀÉ ǅ İx ΑΣ éa", "漢字かな \U0001f600‍ x", "a<|endoftext|>b!!<|startoftext|>", "aaaa aaaaaaa ababab", "\x1c\x1fz  y"]
    for t in texts:
        assert c.table(t).tolist() == [len(c.tokenizer.encode(t[:k], add_special_tokens=False).ids) for k in range(len(t) + 1)], t
    rows = token_counts.count_tokens(docs(spark, EDGES), path, limit=20, with_steps=True).orderBy("doc_id").collect()
    for r, t in zip(rows, EDGES):
        t = t or ""
        n = len(c.tokenizer.encode(t, add_special_tokens=False).ids)
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (len(t.encode()), n, n > 20)
        table = np.concatenate([[0], np.cumsum(np.frombuffer(bytes(r["steps"]), "<i2"))])
        assert r["fit_chars"] == max(k for k, v in enumerate(table) if v <= 20)


def test_prefix_counts_of_joined_characters():
    """Marks, jamo and kana that the normaliser joins, at every prefix, as the library counts it."""
    c = token_counts.counter(public_tokenizers.path("word_bpe_49k.json"))
    rng = random.Random(21)
    alphabet = [*"aens'!-1 ", "\u0301", "\u0308", "\u0327", "é", "İ", "ß", "Σ", "か", "\u3099", "ハ", "\u309a", "\u1100", "\u1161", "\u11a8", "\u0344", "\u09c7", "\u09be", "'re", "Å", "漢"]
    for k in [3, 8, 20] * 60 + [90] * 12:
        t = "".join(rng.choice(rng.sample(alphabet, 6)) for _ in range(k))
        assert c.table(t).tolist() == [len(c.tokenizer.encode(t[:i], add_special_tokens=False).ids) for i in range(len(t) + 1)], ascii(t)


@pytest.mark.parametrize("kind", ["letters", "one", "kana", "marks", "han", "punctuation"])
def test_long_words_take_bounded_memory(kind):
    import tracemalloc
    import unicodedata

    rng = random.Random(22)
    n = 100_000
    text = {
        "letters": lambda: "".join(rng.choice("acgt") for _ in range(n)),
        "one": lambda: "x" * n,
        "kana": lambda: unicodedata.normalize("NFD", "".join(rng.choice("がぎぐげござかきくけこ") for _ in range(n // 2))),
        "marks": lambda: "a" * 4000 + "\u0301" + "e\u0301" * 4000,
        "han": lambda: "".join(chr(0x4E00 + rng.randrange(5000)) for _ in range(n // 2)),
        "punctuation": lambda: "".join(rng.choice("!?-+") for _ in range(n)),
    }[kind]()
    c = token_counts.counter(public_tokenizers.path("word_bpe_49k.json"))
    tracemalloc.start()
    total = int(c.steps(text).sum(dtype=np.int64))
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert total == len(c.tokenizer.encode(text, add_special_tokens=False).ids) and most < 300e6
    assert not any(len(w) > token_counts.SHORT for w in [*c.units, *c.latin_units, *c.nodes])


def test_other_vocabularies():
    with pytest.raises(ValueError, match="word ends"):
        token_counts.PrefixCounter(public_tokenizers.path("byte_bpe_50k.json"))
    code = MemoEncoder(public_tokenizers.path("word_bpe_49k.json"))  # split otherwise: the library's ids
    assert np.frombuffer(code.encode("Two WORDS, é"), "<u4").tolist() == code.tokenizer.encode("Two WORDS, é", add_special_tokens=False).ids


def test_slots_follow_the_keyed_permutation(spark, tmp_path):
    """Ids, slots, shards and manifest against the library and a plain permutation, whatever the partitions are."""
    from tokenizers import Tokenizer

    path = public_tokenizers.path("byte_bpe_50k.json")
    rng = random.Random(3)
    texts = EDGES + [prose(rng, rng.choice([5, 400])) for _ in range(40)]
    ids = [None if i == 4 else i // 2 for i in range(len(texts))]
    library = Tokenizer.from_file(path)
    stream, owner = [], []
    for i, t in zip(ids, texts):
        found = [*library.encode(t or "", add_special_tokens=False).ids, 50256]
        stream += found
        owner += [i] * len(found)
    length, rows = 64, 50
    n = -(-len(stream) // length)
    slots = token_output.Feistel(n, 17).forward(np.arange(n)).tolist()
    assert sorted(slots) == list(range(n)) and slots != sorted(slots)
    files = spark.createDataFrame([(i, t, "a" if k < 30 else "b", k, 7) for k, (i, t) in enumerate(zip(ids, texts))], "doc_id long, text string, file string, row long, shard int")
    for parts in (1, 5):
        d = files.repartitionByRange(parts, "row").sortWithinPartitions("row")
        manifest, where = token_output.write_shards(d, path, length=length, rows=rows, path=f"file://{tmp_path}/shards{parts}", order=("file", "row"))
        got = {r["slot"]: r for r in manifest.collect()}
        sequences = list(token_output.read_sequences(where))
        assert sorted(got) == list(range(n)) and len(sequences) == n
        for number, slot in enumerate(slots):
            want = stream[number * length : (number + 1) * length]
            assert sequences[slot].tolist() == want + [0] * (length - len(want))
            r = got[slot]
            assert (r["shard"], r["byte_offset"], r["n_tokens"]) == (slot // rows, slot % rows * length * 2, len(want))
            assert r["ids_crc32"] == zlib.crc32(np.array(want, dtype="<u2").tobytes()) and r["doc_ids"] == list(dict.fromkeys(owner[number * length : (number + 1) * length]))
        assert [s.tolist() for s in token_output.read_sequences(where, 47, 9)] == [s.tolist() for s in sequences[47:56]]
    again, _ = token_output.write_shards(docs(spark, []), path, path=f"file://{tmp_path}/none")
    assert again.count() == 0
    plain, where = token_output.write_shards(docs(spark, texts), path, length=length, path=f"file://{tmp_path}/plain")
    assert plain.count() == n == len(list(token_output.read_sequences(where)))


@pytest.mark.parametrize("size", [1, 2, 3, 10, 1000, 4097])
def test_feistel_is_a_permutation(size):
    f = token_output.Feistel(size, 5)
    x = f.forward(np.arange(size))
    assert sorted(x.tolist()) == list(range(size)) and f.inverse(x).tolist() == list(range(size))
    assert size < 1000 or (x != token_output.Feistel(size, 6).forward(np.arange(size))).any()


# ---- near duplicates


def closure(ids, links):
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in links:
        x, y = sorted((find(a), find(b)))
        root[y] = x
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("percent", [80, 85])
def test_near_duplicates_like_brute_force(spark, percent):
    rng = random.Random(4)
    base = [prose(rng, n) for n in (120, 200, 40, 8)]
    texts = [None, "", "  ", "one two", "ONE two", "one  two\n", "one two three"]
    for b in base:
        for _ in range(25):
            w = b.split()
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = rng.choice(VOCABULARY)
            texts.append(" ".join(w) if rng.random() < 0.8 else " ".join(w).upper())
    texts += [prose(rng, 60) for _ in range(20)]
    ids = rng.sample(range(1000), len(texts))
    sets = []
    for t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate({c: c + 32 for c in range(65, 91)}))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set())
    links = [(ids[i], ids[j]) for i in range(len(ids)) for j in range(i) if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])]
    want = closure(ids, links)
    d = docs(spark, texts, ids=ids)
    got = near_duplicates.duplicates(d, percent, block=8, hot=48).collect()
    assert {r["doc_id"]: r["component_id"] for r in got} == want
    assert {r["doc_id"]: r["n_shingles"] for r in got} == {i: len(s) for i, s in zip(ids, sets)}
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in got)
    kept = near_duplicates.without_duplicates(d, percent, block=16)
    assert kept.columns == d.columns and sorted(r["doc_id"] for r in kept.collect()) == sorted(set(want.values()))


def test_thousands_of_near_copies_and_a_chain(spark):
    """One group whose members all link, one whose members link with their neighbours alone, both in many blocks and under hot keys."""
    rng = random.Random(18)
    base = prose(rng, 150).split()
    texts = []
    for i in range(3000):
        w = base[:]
        w[rng.randrange(len(w))] = f"w{i}"
        texts.append(" ".join(w))
    words = [f"t{rng.randrange(10**6)}" for _ in range(900)]
    texts += [" ".join(words[8 * i : 8 * i + 150]) for i in range(90)]  # 138 of 154 shingles with the next, 130 of 162 with the one after
    ids = rng.sample(range(10_000), len(texts))
    got = {r["doc_id"]: r["component_id"] for r in near_duplicates.duplicates(docs(spark, texts, ids=ids), block=32, hot=512).collect()}
    assert {got[i] for i in ids[:3000]} == {min(ids[:3000])} and {got[i] for i in ids[3000:]} == {min(ids[3000:])}


def test_near_duplicates_keep_any_columns(spark):
    rng = random.Random(19)
    one = prose(rng, 40)
    d = docs(spark, [one, one, one + " x", None, "", one, prose(rng, 10)], ids=[4, 2, 3, 7, 8, 2, None])
    clash = d.withColumns({c: F.lit(i) for i, c in enumerate(("node", "root", "id", "n", "set", "kept", "component_id", "grp", "row", "text_", "count"))})
    out = near_duplicates.without_duplicates(clash)
    assert out.columns == clash.columns and sorted(str(r["doc_id"]) for r in out.collect()) == ["2", "7", "8", "None"]
    assert {r["n"] for r in out.collect()} == {3}


def test_near_duplicates_edges(spark):
    assert near_duplicates.duplicates(docs(spark, [])).count() == 0
    d = docs(spark, ["a b c d e f", "a b c d e f", "a b c d e f", "other"], ids=[3, 3, None, 5])
    got = sorted((r["doc_id"] or -1, r["component_id"] or -1, r["kept"]) for r in near_duplicates.duplicates(d).collect())
    assert got == [(-1, -1, True), (3, 3, True), (3, 3, True), (5, 5, True)]
    assert sorted(str(r["doc_id"]) for r in near_duplicates.without_duplicates(d).collect()) == ["3", "5", "None"]


def test_signature_guarantee():
    for s in (0.8, 0.85):
        limit = near_duplicates.distance_limit(s)
        parts = near_duplicates.chunks(limit)
        assert sum(map(len, parts)) == near_duplicates.SYMBOLS and limit < 2 * len(parts)


def test_components(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, 2000 + i) for i in range(50)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(edges, "a long, b long")
    real = [(a, b) for a, b in edges if a is not None and a != b]
    want = closure({x for e in real for x in e}, real)
    assert {r["node"]: r["root"] for r in components(df).collect()} == want
    assert components(df.limit(0)).count() == 0


@pytest.mark.parametrize("shard", [7, 30, 2048])
def test_near_vectors_like_brute_force(spark, shard):
    rng = np.random.default_rng(6)
    base = rng.normal(size=(6, 16))
    rows, i = [], 0
    for b in base:
        for k in range(12):
            v = b + rng.normal(size=16) * rng.choice([0.01, 0.05, 0.12])
            rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 3])], int(k % 2)))
            i += 1
    rows += [(i + j, rows[j][1], rows[j][2]) for j in range(5)]
    bad = [(900, None, 0), (901, [0.0] * 16, 0), (902, [float("nan")] + [1.0] * 15, 0), (903, [None] + [1.0] * 15, 0), (904, rows[0][1], None), (905, rows[0][1][:8], 0), (906, [float("inf")] + [0.0] * 15, 0), (907, [], 0)]
    x = np.array([r[1] for r in rows])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    hit = [(rows[a][0], rows[b][0]) for a in range(len(rows)) for b in range(a) if rows[a][2] == rows[b][2] and x[a] @ x[b] >= 0.98]
    want = closure([r[0] for r in rows + bad], hit)
    n = collections.Counter(y for h in hit for y in h)
    df = spark.createDataFrame(rows + bad, "vec_id long, embedding array<float>, label int")
    got = near_vectors.near_vectors(df, shard=shard, sample=20).collect()
    assert {r["vec_id"]: (r["n_links"], r["component_id"]) for r in got} == {v: (n[v], want[v]) for v in want}
    assert near_vectors.near_vectors(df.limit(0)).count() == 0


def test_cells_that_are_far_apart_never_meet(spark):
    """Tight groups fall into cells of their own, so pairs of cells are dropped before any row moves; a heavy cell goes in parts."""
    rng = np.random.default_rng(23)
    base = rng.normal(size=(8, 24))
    base /= np.linalg.norm(base, axis=1, keepdims=True)
    rows = [(i, [float(x) for x in base[i % 8 if i < 640 else 0] + rng.normal(size=24) * 0.004], "a") for i in range(800)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in near_vectors.near_vectors(df, shard=100).collect()}
    sizes = collections.Counter(i % 8 if i < 640 else 0 for i in range(800))
    assert got == {i: (sizes[i % 8 if i < 640 else 0] - 1, i % 8 if i < 640 else 0) for i in range(800)}
    classes = df.select(F.col("vec_id").alias("node"), "label", F.size("embedding").alias("dim"), "embedding", F.lit(1).alias("copies"))
    groups = near_vectors._blocks(classes, 0.2, 100, 4096).groupBy("grp").agg(F.count("*").alias("n")).collect()
    assert len(groups) < 36 and max(r["n"] for r in groups) <= 300  # 8 cells, of which all pairs would be 36


# ---- personal data


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(sum(divmod(int(c) * (1 + i % 2), 10)) for i, c in enumerate(reversed(d))) % 10 == 0

    out = [(m.start(), 0, m.end(), "email") for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [(m.start(), 1, m.end(), "ip") for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [(m.start(), 2, m.end(), "card") for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 12 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))]
    out += [(m.start(), 3, m.end(), "phone") for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return [(s, e, k) for s, _, e, k in sorted(out)]


def test_base_spans_like_the_patterns():
    rng = random.Random(7)
    pieces = ["4111 1111 1111 1111", "4111-1111-1111-1112", "+1 (555) 010-9999", "a.b+c@d-e.co.uk", "x@@y.zz", "a@b@c.de.f", "1.2.3.4", "256.1.1.1", "1.2.3.4.5", "001.02.3.255", "@", ".", " ", "é", "+", "12", "-", "4242424242424242", "a@b", "q@r.s."]
    pieces += ["1.2", "255", "0000000255", ".", "3.4.5.6.7.8.9"]
    for _ in range(4000):
        t = "".join(rng.choice(pieces) + rng.choice(["", "", " "]) for _ in range(rng.randrange(1, 9)))
        assert personal_data.base_spans(t) == plain_spans(t), t


@pytest.mark.parametrize("code", ["GB82WEST12345698765432", "DE89 3704 0044 0532 0130 00", "NO93 8601 1117 947", "MT84MALT011000012345MTLCAST001S"])
@pytest.mark.parametrize("after", ["", " BIC COBADEFFXXX", " WESTGB22", " THANKS", " 2024-01-02", " 12", ", DE88 3704 0044 0532 0130 00"])
def test_ibans_whatever_follows(code, after):
    text = f"IBAN {code}{after}"
    assert [(s, e) for k, s, e, _ in personal_data.scored_spans(text) if k == "iban"] == [(5, 5 + len(code))]
    assert "[IBAN]" in personal_data.redacted(text) and code not in personal_data.redacted(text)
    assert not list(personal_data._ibans(f"{code}0{after}")) and not list(personal_data._ibans("ZZ" + code[2:]))


@pytest.mark.parametrize("unit", ["7", "1.", "1.2.", "+1", "a@", "@", "AB12", "1 ", "1-1.", "(12) ", "é ", "a.b-"])
def test_long_texts_take_linear_time(unit):
    import time

    text = unit * (1_000_000 // len(unit))
    began = time.perf_counter()
    personal_data.scored_spans(text)
    assert time.perf_counter() - began < 12  # a million digits took nine minutes when each start was tried


def test_spans_and_redaction(spark):
    texts = ["Call 030 123 456 78 now", "030 123 456 78", "pay to DE89 3704 0044 0532 0130 00 please", "DE88 3704 0044 0532 0130 00", "card 4111111111111111, mail a@b.cc", *EDGES]
    rows = personal_data.digest(personal_data.find_spans(docs(spark, texts))).orderBy("doc_id").collect()
    assert [r["spans"] for r in rows[:5]] == ["number:5:19", "", "iban:7:34", "", "card:5:21,email:28:34"]
    for r, t in zip(rows, texts):
        base = plain_spans(t or "")
        assert r["base_sha256"] == hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, e, k in base).encode()).hexdigest()
        assert [r[f"n_{k}"] for k in personal_data.BASE] == [sum(x[2] == k for x in base) for k in personal_data.BASE]
    clean = personal_data.redact(docs(spark, texts)).orderBy("doc_id").collect()
    assert clean[4]["text"] == "card [CARD], mail [EMAIL]" and clean[4]["n_chars"] == len(clean[4]["text"]) and clean[5]["text"] is None
    assert all(not plain_spans(r["text"] or "") for r in clean) and [r["extra"] for r in clean] == ["x"] * len(texts)


# ---- quality, mixing, toxicity


def test_rules_like_plain_counts(spark):
    rng = random.Random(8)
    texts = EDGES + ["a b c d e f g\na b c d e f g\n\n \n a b c d e f g", "x y " * 40, "A#b *c$ d%&|<>", *(prose(rng, n) + "\n" + prose(rng, 9) for n in (4, 5, 20, 60)), "1 2 3 4 5 1 2 3 4 5 6 7"]
    rows = quality_rules.judge(docs(spark, texts, langs=[None, "en", "xx"] + ["en"] * (len(texts) - 3))).orderBy("doc_id").collect()
    for r, t in zip(rows, texts):
        t = t or ""
        w = re.findall(r"[^\x20\x09-\x0D]+", t)
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        n = collections.Counter(windows)
        covered = {j for i, x in enumerate(windows) if n[x] > 1 for j in range(i, i + 5)}
        lines = [x for x in t.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
        assert (r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"]) == (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(covered)), t[:40]
        assert r["base_failed"] == (len(w) < 10 or 100 * len(covered) > 20 * len(w)) and not (r["kept"] and r["base_failed"])
    assert quality_rules.judge(docs(spark, [])).count() == 0


def test_jensen_shannon(spark):
    df = spark.createDataFrame([([1.0, 0.0], [0.0, 1.0]), ([0.5, 0.5], [0.5, 0.5]), ([0.75, 0.25], [0.25, 0.75])], "p array<double>, q array<double>")
    got = [r[0] for r in df.select(quality_rules.jensen_shannon(F.col("p"), F.col("q"))).collect()]
    assert got == pytest.approx([1.0, 0.0, 0.43440], abs=1e-4)


def test_mixing(spark):
    rng = random.Random(9)
    sources = [rng.choice(["a", "b", "c", "ß", None]) for _ in range(400)] + ["hot"] * 600
    texts = [None if i % 50 == 7 else prose(rng, rng.choice([1, 3, 10, 80])) for i in range(len(sources))]
    texts[400:800] = ["five words of equal size"] * 400
    rows = mixing.mix(docs(spark, texts, sources=sources), bucket=50).collect()
    sizes = collections.Counter()
    for t, s in zip(texts, sources):
        sizes[s] += len((t or "").split())
    order = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, free, rest = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        w = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / w > 2 * sizes[s]]
        target |= {s: 2.0 * sizes[s] for s in over} if over else {s: rest * weight[s] / w for s in free}
        free -= set(over) if over else free
        rest -= sum(target[s] for s in over)
    taken = collections.Counter()
    for r in rows:
        s = sources[r["doc_id"]]
        assert r["source_size"] == sizes[s] and r["target"] == pytest.approx(target[s]) and r["taken"] <= 2 * r["size"] and r["size"] == len((texts[r["doc_id"]] or "").split())
        taken[s] += r["taken"]
    assert all(abs(taken[s] - target[s]) <= 3 for s in order)
    again = mixing.mix(docs(spark, texts, sources=sources).repartition(7), bucket=50)
    assert {r["doc_id"]: r["taken"] for r in again.collect()} == {r["doc_id"]: r["taken"] for r in rows}
    d = docs(spark, texts, sources=sources)
    out = mixing.mixed(d, bucket=50)
    assert out.columns == d.columns
    assert collections.Counter(r["doc_id"] for r in out.collect()) == collections.Counter({r["doc_id"]: r["copies"] for r in rows if r["copies"]})
    assert mixing.mix(docs(spark, [])).count() == 0
    assert {r["taken"] for r in mixing.mix(docs(spark, [None, ""])).collect()} == {0}


def test_rates_solve_the_dual(spark):
    """Words and length bands at the rates against the optimum's conditions; sources' targets against many sources."""
    rng = random.Random(20)
    rows = [(f"s{s}", size, rng.randrange(1, 5)) for s in range(8) for size in sorted({int(math.exp(rng.uniform(0, 9 - s % 4))) for _ in range(40)})]
    classes = spark.createDataFrame(rows, "skey string, size long, n long")
    sizes = collections.Counter()
    for s, size, n in rows:
        sizes[s] += size * n
    factors = dict(zip(sorted(sizes), (0.3, 0.9, 1.0, 1.4, 1.9, 1.999, 2.0, 0.0)))
    sources = spark.createDataFrame([(s, float(v), v * factors[s]) for s, v in sizes.items()], "skey string, source_size double, target double")
    got = mixing.rates(classes, sources).collect()
    total = sum(sizes.values())
    overall = sum(size.bit_length() * size * n for _, size, n in rows) / total - 1
    for s in sizes:
        rate = {r["band"]: r["rate"] for r in got if r["skey"] == s}
        own = [(size, n, size.bit_length() - 1) for t, size, n in rows if t == s]
        mean = sum(k * size * n for size, n, k in own) / sizes[s]
        target = sizes[s] * factors[s]
        assert all(0 <= r <= 2 for r in rate.values()) and sum(rate[k] * size * n for size, n, k in own) == pytest.approx(target, rel=1e-9)
        if not 0 < factors[s] < 2:
            assert set(rate.values()) == {factors[s]}
            continue
        # at the optimum the moment's rest is ridge * target * m, m being the slope of the logarithm of free rates
        m = next(r["m"] for r in got if r["skey"] == s)
        free = sorted(k for k, r in rate.items() if r < 2)
        assert all(math.log(rate[b] / rate[a]) == pytest.approx(m * (b - a), abs=1e-9) for a, b in zip(free, free[1:]))
        shift = max(-1.0, min(1.0, 0.25 * (overall - mean)))
        assert sum(rate[k] * size * n * (k - mean) for size, n, k in own) == pytest.approx(target * (shift - m), abs=1e-3 * target)


def test_targets_of_many_sources(spark):
    sizes = {f"h{i:04d}": (i * 7919) % 1000 for i in range(2000)} | {None: 500}
    df = spark.createDataFrame([("n" if s is None else "s" + s, s, n) for s, n in sizes.items()], "skey string, source string, size long")
    got = {r["source"]: r["target"] for r in mixing.targets(df).collect()}
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate([*sorted(s for s in sizes if s is not None), None])}
    target, free, rest = {}, set(sizes), 1.5 * sum(sizes.values())
    while free:
        w = sum(weight[s] for s in free)
        over = [s for s in free if rest * weight[s] / w >= 2 * sizes[s]]
        target |= {s: 2.0 * sizes[s] for s in over} if over else {s: rest * weight[s] / w for s in free}
        free -= set(over) if over else free
        rest -= sum(target[s] for s in over)
    assert got == pytest.approx(target)


def test_mixed_keeps_any_columns(spark):
    texts = ["a b c", "d e", "a b c", None, "f g h i"] * 6
    d = docs(spark, texts, ids=[i // 2 for i in range(30)], sources=["x", None, "y"] * 10)
    clash = d.withColumns({c: F.lit(i) for i, c in enumerate(("mix_id", "given_id", "left_id", "left_size", "skey", "size", "copies", "rows", "times", "copy", "own_0_"))})
    out = mixing.mixed(clash)
    assert out.columns == clash.columns
    want = collections.Counter()
    for r in mixing.mix(d).collect():
        want[r["doc_id"]] += r["copies"]
    assert collections.Counter(r["doc_id"] for r in out.collect()) == +want and {r["mix_id"] for r in out.collect()} == {0}


def test_mixing_of_many_sizes(spark):
    d = spark.range(6000).select(F.col("id").alias("doc_id"), F.expr("repeat('a ', int(id) + 1)").alias("text"), F.lit("s").alias("source"))
    rows = mixing.mix(d).collect()
    assert {r["size"] for r in rows} == set(range(1, 6001))
    assert abs(sum(r["taken"] for r in rows) - rows[0]["target"]) <= 3
    large = [r["copies"] for r in rows if r["size"] > 3000]
    assert set(large) == {1, 2} and abs(sum(large) / len(large) - 1.5) < 0.01


def test_kneser_ney_like_dictionaries(spark):
    rng = random.Random(10)
    size, order = 5, 3
    text = [rng.randrange(1, size) if rng.random() < 0.9 else 0 for _ in range(400)]
    counts = collections.Counter(tuple(text[i : i + order]) for i in range(len(text) - order + 1))
    code = lambda g: sum(x * size ** (len(g) - 1 - i) for i, x in enumerate(g))
    tables = {order: counts}
    for k in range(order - 1, 0, -1):
        tables[k] = collections.Counter(g[1:] for g in tables[k + 1])

    def p(g):
        k = len(g)
        if not k:
            return 1 / size
        t = tables[k]
        n = [sum(c == i for c in t.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        d = [0, *(max(0.0, min(0.99 * i, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] and n[i + 1] else 0.5 for i in (1, 2, 3))]
        disc = lambda c: min(d[min(c, 3)], 0.99 * c)
        mates = [t[g[:-1] + (x,)] for x in range(size) if t[g[:-1] + (x,)]]
        if not mates:
            return p(g[1:])
        c = t[g]
        return (c - disc(c) if c else 0) / sum(mates) + sum(map(disc, mates)) / sum(mates) * p(g[1:])

    df = spark.createDataFrame([(code(g), c) for g, c in counts.items()], "code long, n long")
    for k, (found, _) in enumerate(quality_model.kneser_ney(df, size, order), 1):
        got = {r["code"]: r["p"] for r in found.collect()}
        assert got == pytest.approx({code(g): p(g) for g in tables[k]})
    assert sum(p((1, 2, x)) for x in range(size)) == pytest.approx(1)


def test_quality_model(spark):
    rng = random.Random(11)
    good = [prose(rng, 60) for _ in range(60)]
    junk = [" ".join("".join(rng.choice("QZXJ#*") for _ in range(6)) for _ in range(40)) for _ in range(10)]
    d = docs(spark, good + junk + [None, ""], langs=["en"] * 30 + [None] * 30 + ["en"] * 12)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(0, 60, 2)] + [(0, 1, 0), (60, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality_model.verdicts(d, labels).collect()}
    assert all(rows[i]["kept"] for i in range(60)) and not any(rows[i]["kept"] for i in range(60, 72)) and rows[70]["bits"] is None
    out = quality_model.filtered(d, labels)
    assert out.columns == d.columns and out.count() == 60
    clash = d.withColumns({c: F.lit(i) for i, c in enumerate(("bits", "limit", "kept", "bits_limit", "lang_key", "lm_limit_"))})
    again = quality_model.filtered(clash, labels)
    assert again.columns == clash.columns and {r["bits"] for r in again.collect()} == {0} and again.count() == 60
    none = {r["doc_id"]: r["kept"] for r in quality_model.verdicts(d, labels.where("false")).collect()}
    assert none[65] and not none[71]


def test_quality_model_junk_of_any_script(spark):
    rng = random.Random(14)
    good = [prose(rng, 60) + f" 12 & 30 {i}." for i in range(60)]
    scripts = ["0123456789", "#$%&*@^~", "абвгдежзиклмнопрст", [chr(0x4E00 + i) for i in range(3000)], "QZXJKW"]
    junk = ["".join(rng.choice(s) for _ in range(2000)) for s in scripts]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    rows = {r["doc_id"]: r for r in quality_model.verdicts(docs(spark, good + junk), labels).collect()}
    assert all(rows[i]["kept"] for i in range(60)) and not any(rows[i]["kept"] for i in range(60, 65))
    assert all(rows[i]["bits"] > math.log2(len(set(s))) for i, s in zip(range(60, 65), scripts))


def plain_bits(trusted, texts, order):
    """Bits per character of texts under an interpolated modified Kneser-Ney model of the trusted texts' bytes, by dictionaries."""
    grams = lambda t, k: [tuple(([0] * (order - 1) + [b + 1 for b in t.encode()])[i + order - k : i + order]) for i in range(len(t.encode()))]
    tables = {order: collections.Counter(g for t in trusted for g in grams(t or "", order))}
    for k in range(order - 1, 0, -1):
        tables[k] = collections.Counter(g[1:] for g in tables[k + 1])
    mates = {k: collections.defaultdict(list) for k in tables}
    discounts = {}
    for k, t in tables.items():
        n = [sum(c == i for c in t.values()) for i in range(5)]
        y = n[1] / (n[1] + 2 * n[2]) if n[1] and n[2] else 0.5
        discounts[k] = [max(0.0, min(0.99 * i, i - (i + 1) * y * n[i + 1] / n[i])) if n[i] and n[i + 1] else 0.5 for i in (1, 2, 3)]
        for g, c in t.items():
            mates[k][g[:-1]].append(c)

    def p(g):
        k = len(g)
        if not k:
            return 1 / 257
        cut = lambda c: min(discounts[k][min(c, 3) - 1], 0.99 * c)
        m, c = mates[k][g[:-1]], tables[k][g]
        return ((c - cut(c) if c else 0) + sum(map(cut, m)) * p(g[1:])) / sum(m) if m else p(g[1:])

    return {i: sum(-math.log2(p(g)) for g in grams(t, order)) / len(t) for i, t in texts.items() if t}


def test_bits_and_verdicts_like_a_plain_model(spark):
    """Every document's bits, limit and verdict against dictionaries of byte n-grams."""
    rng = random.Random(17)
    texts = [prose(rng, rng.randrange(1, 50)) for _ in range(45)] + ["Straße 漢字 ©", "zzzz zzzz qqqq", "", None, "the of and", "the of and"]
    langs = [rng.choice(["en", "de", None]) for _ in texts]
    d, order = docs(spark, texts, langs=langs), 3
    trusted = set(rng.sample(range(len(texts)), 30)) | {45}
    labels = spark.createDataFrame([(i, int(i in trusted), 0) for i in range(len(texts))], "doc_id long, quality int, toxic int")
    apart = {r[0] for r in spark.range(len(texts)).where("pmod(xxhash64(id, 'apart'), 4) = 0").collect()}
    bits = plain_bits([texts[i] for i in trusted - apart], dict(enumerate(texts)), order)
    excess = {i: b - 6 / math.sqrt(len(texts[i])) for i, b in bits.items()}
    left = [i for i in trusted & apart if i in bits]
    scatter = max(0.1, float(np.std([excess[i] for i in left])))
    rank = lambda v: sorted(v)[max(0, math.ceil(0.9 * len(v)) - 1)] + 3 * scatter / math.sqrt(len(v)) if v else None
    limits = {x: rank([excess[i] for i in left if langs[i] == x]) for x in set(langs)}
    for r in quality_model.verdicts(d, labels, quantile=0.9, apart=4, order=order, head=30).collect():
        i = r["doc_id"]
        if i not in bits:
            assert r["bits"] is None and not r["kept"]
            continue
        limit = limits[langs[i]] if limits[langs[i]] is not None else rank([excess[j] for j in left])
        assert r["bits"] == pytest.approx(bits[i], abs=1e-4) and r["bits_limit"] == pytest.approx(limit + 6 / math.sqrt(len(texts[i])), abs=1e-4)
        assert r["kept"] == (r["bits"] <= r["bits_limit"])


def test_quality_scores_do_not_depend_on_the_broadcast(spark):
    rng = random.Random(15)
    texts = [prose(rng, 50) for _ in range(20)] + ["漢字 123", "same", "same", None, ""]
    d = docs(spark, texts, ids=[*range(20), None, 30, 30, 31, 32])
    labels = spark.createDataFrame([(i, 1, 0) for i in range(10)], "doc_id long, quality int, toxic int")
    order = lambda rows: sorted(((r["doc_id"] or -1, r["bits"] or -1, r["kept"]) for r in rows))
    want = order(quality_model.verdicts(d, labels).collect())
    assert len(want) == len(texts) and order(quality_model.verdicts(d, labels, head=40).collect()) == order(quality_model.verdicts(d, labels, head=0).collect()) == want


def test_toxicity_held_out(spark):
    rng = random.Random(12)
    insults = ["dunceful", "grimlout", "vexwort"]
    texts, toxic = [], []
    for i in range(600):
        w = prose(rng, 40).split()
        if i % 5 == 0:
            w[rng.randrange(40)] = rng.choice(insults) + rng.choice(["", "a", "ix"])
            w[rng.randrange(40)] = rng.choice(insults).upper() + "!"
        texts.append(" ".join(w))
        toxic.append(int(i % 5 == 0))
    d = docs(spark, texts + [None, ""])
    labels = spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)] + [(None, 1, 1)], "doc_id long, quality int, toxic int")
    out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    machine = toxicity.train(d, labels, held_out=out)
    rows = toxicity.score(d, machine).collect()
    held = [r for r in rows if r["doc_id"] < 600 and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0]
    assert all(0 <= r["score"] <= 1 for r in rows) and len(held) > 80
    assert sum((r["score"] >= 0.5) == toxic[r["doc_id"]] for r in held) >= 0.98 * len(held)
    assert toxicity.train(d, labels.where("toxic = 0")).score("anything") < 0.01


def test_pairs_have_weights_of_their_own():
    rng = random.Random(13)
    rows = []
    for _ in range(1500):  # toxic only if both an insult and a mention are there
        a, b = rng.random() < 0.5, rng.random() < 0.5
        rows.append((toxicity.terms(" ".join(["plain"] + ["grimlout"] * a + ["villagers"] * b)), int(a and b)))
    m = toxicity.fit(rows, np.concatenate([toxicity.terms("grimlout"), toxicity.terms("villagers")]), 0.25)
    assert m.score("grimlout villagers") > 0.5 > max(m.score("grimlout"), m.score("villagers"), m.score("plain"))


def test_scores_like_the_written_out_sum(spark):
    rng = random.Random(16)
    texts = [prose(rng, rng.randrange(3, 60)) + (" grimlout vexwort" if i % 3 == 0 else "") for i in range(150)] + EDGES
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(150)], "doc_id long, quality int, toxic int")
    d = docs(spark, texts)
    m = toxicity.train(d, labels)
    # inputs: every bucket whose chi-square over all labelled documents reaches the limit
    held = [set(toxicity.terms(t).tolist()) for t in texts[:150]]
    want = set()
    for bucket in set().union(*held):
        table = [[sum((bucket in h) == x and int(i % 3 == 0) == y for i, h in enumerate(held)) for x in (False, True)] for y in (0, 1)]
        rows, cols = [sum(r) for r in table], [sum(c) for c in zip(*table)]
        chi = sum((table[y][x] - rows[y] * cols[x] / 150) ** 2 / (rows[y] * cols[x] / 150) for x in (0, 1) for y in (0, 1)) if all(cols) else 0
        if chi >= 8 and cols[1] >= 3:
            want.add(bucket)
    assert set(m.index) == want and want
    for r in toxicity.score(d, m).collect():
        i = [m.index[b] for b in toxicity.terms(texts[r["doc_id"]] or "").tolist() if b in m.index]
        z = m.bias + sum(m.linear[a] for a in i) + sum(float(m.factors[a] @ m.factors[b]) for k, a in enumerate(i) for b in i[:k])
        assert r["score"] == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, z)))))


def test_other_columns_of_any_name_do_not_matter(spark):
    """Operators that add columns of their own give the same rows whatever else the table holds, and redaction keeps it all."""
    names = "node f1 f2 cell part grp side dim copies least salt size words spans kind score toxic terms ids start first n place slot shard file base h1 lines listed common kept bits root".split()
    texts = ["mail a@b.cc now", "the same text here again and again", None, "", "the same text here again and again"]
    d = spark.createDataFrame([(i, t, "en", "s") for i, t in enumerate(texts)], "doc_id long, text string, lang string, source string")
    clash = d.withColumns({c: F.lit(i) for i, c in enumerate(names)})
    v = spark.createDataFrame([(i, [float(i // 2), 1.0], "a") for i in range(6)], "vec_id long, embedding array<double>, label string")
    words, pieces = (public_tokenizers.path(f"{x}.json") for x in ("word_bpe_49k", "byte_bpe_50k"))
    rows = lambda df: sorted(map(repr, df.collect()))
    for run in (
        lambda x: personal_data.digest(personal_data.find_spans(x)),
        quality_rules.judge,
        lambda x: token_counts.count_tokens(x, words),
        lambda x: packing.pack(x.coalesce(1), pieces).drop("ids"),
        lambda x: toxicity.score(x, toxicity.Machine()),
    ):
        assert rows(run(clash)) == rows(run(d))
    assert rows(near_vectors.near_vectors(v.withColumns({c: F.lit(1) for c in names}))) == rows(near_vectors.near_vectors(v))
    out = personal_data.redact(clash)
    assert out.columns == clash.columns and rows(out.drop("text")) == rows(clash.drop("text"))


def test_empty_tables(spark):
    d = docs(spark, [])
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    path = public_tokenizers.path("word_bpe_49k.json")
    assert token_counts.count_tokens(d, path).count() == personal_data.digest(personal_data.find_spans(d)).count() == personal_data.redact(d).count() == 0
    assert quality_model.verdicts(d, labels).count() == quality_model.filtered(d, labels).count() == 0
    assert toxicity.score(d, toxicity.train(d, labels)).count() == mixing.mixed(d).count() == 0


def test_pipeline_like_plain_stages(spark, tmp_path):
    """Every stage against a plain version of it, and run() against the stages one after the other."""
    import corpus_pipeline
    from tokenizers import Tokenizer

    rng = random.Random(24)
    good = [prose(rng, rng.randrange(30, 90)) for _ in range(40)]
    texts = {i: t for i, t in enumerate(good)}
    texts |= {40 + i: " ".join([*good[i].split()[:-1], "changed"]) for i in range(6)}  # near copies
    texts |= {46: good[3], 47: good[3], 48: "", 49: None}
    texts |= {50 + i: f"{good[10 + i]} mail a{i}@b.cc or 4111 1111 1111 1111 {prose(rng, 30)}" for i in range(5)}
    texts |= {60 + i: "".join(rng.choice("QZX#*[]{}") for _ in range(200)) for i in range(8)}
    rows = [(i, t, rng.choice(["en", "de", None]), rng.choice(["a", "b", None]), len(t or ""), "kept") for i, t in texts.items()]
    rows += [rows[5], rows[5]]
    schema = "doc_id long, text string, lang string, source string, n_chars long, bits string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/documents.parquet")
    trusted = set(range(0, 40, 2)) | {50, 51}
    spark.createDataFrame([(i, int(i in trusted), 0) for i in range(68)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = [spark.read.parquet(f"{tmp_path}/documents.parquet")]
    for _, stage in corpus_pipeline.STAGES:
        out.append(corpus_pipeline.materialize(stage(spark, out[-1], str(tmp_path)), "test-stage"))
    got = [x.collect() for x in out]
    assert all(x.columns == out[0].columns for x in out[:5]) and {r["bits"] for r in got[4]} == {"kept"}
    # 1: documents whose bits are beyond their language's limit go, repeated rows stay
    apart = {r[0] for r in spark.range(100).where("pmod(xxhash64(id, 'apart'), 10) = 0").collect()}
    bits = plain_bits([texts[i] for i in trusted - apart] + [texts[5]] * 0, texts, quality_model.ORDER)
    excess = {i: b - 6 / math.sqrt(len(texts[i])) for i, b in bits.items()}
    left = [i for i in trusted & apart if i in bits]
    scatter = max(0.1, float(np.std([excess[i] for i in left])))
    limit = lambda v: sorted(v)[max(0, math.ceil(0.995 * len(v)) - 1)] + 3 * scatter / math.sqrt(len(v))
    own = {r[2]: [excess[i] for i in left if texts[i] is not None and next(x[2] for x in rows if x[0] == i) == r[2]] for r in rows}
    kept = [r[0] for r in rows if r[0] in bits and excess[r[0]] <= limit(own[r[2]] or [excess[i] for i in left])]
    assert left and sorted(r["doc_id"] for r in got[1]) == sorted(kept) and 0 < len(set(kept)) < len(texts)
    # 2: one document of each group of similar ones
    sets = {i: {tuple(w[k : k + 5]) for w in [texts[i].lower().split()] for k in range(max(1, len(w) - 4))} for i in set(kept)}
    links = [(i, j) for i in sets for j in sets if i < j and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    roots = set(closure(sets, links).values())
    assert links and sorted(r["doc_id"] for r in got[2]) == sorted(roots)
    # 3: personal data by its kind
    clean = {i: re.sub(r"4111 1111 1111 1111", "[CARD]", re.sub(r"a\d@b\.cc", "[EMAIL]", texts[i])) for i in roots}
    assert {r["doc_id"]: (r["text"], r["n_chars"]) for r in got[3]} == {i: (t, len(t)) for i, t in clean.items()} and any("[CARD]" in t for t in clean.values())
    # 4: whole copies, two at most, whose words come near each source's target
    copies, sizes, taken = collections.Counter(r["doc_id"] for r in got[4]), collections.Counter(), collections.Counter()
    source = {r["doc_id"]: r["source"] for r in got[3]}
    for i, t in clean.items():
        sizes[source[i]] += len(t.split())
        taken[source[i]] += copies[i] * len(t.split())
    order = sorted((x for x in sizes if x is not None), key=lambda x: x.encode()) + [None] * (None in sizes)
    weight = {x: (5, 2, 1)[k % 3] for k, x in enumerate(order)}
    target, free, rest = {}, set(order), 1.5 * sum(sizes.values())
    while free:
        w = sum(weight[x] for x in free)
        over = [x for x in free if rest * weight[x] / w > 2 * sizes[x]]
        target |= {x: 2.0 * sizes[x] for x in over} if over else {x: rest * weight[x] / w for x in free}
        free -= set(over) if over else free
        rest -= sum(target[x] for x in over)
    assert max(copies.values()) <= 2 and all(abs(taken[x] - target[x]) < min(len(t.split()) for i, t in clean.items() if source[i] == x) for x in order)
    # 5: every copy's ids once, in sequences without gaps
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    want = {i: len(library.encode(clean[i], add_special_tokens=False).ids) + 1 for i in copies}
    for found in (got[5], corpus_pipeline.run(spark, str(tmp_path)).collect()):
        tokens, sequences = collections.Counter(), collections.defaultdict(list)
        for r in found:
            assert r["doc_tokens"] == want[r["doc_id"]]
            tokens[r["doc_id"]] += r["length"]
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        assert tokens == {i: n * want[i] for i, n in copies.items()}
        for s in sequences.values():
            ends = np.cumsum([n for _, n in sorted(s)]).tolist()
            assert [o for o, _ in sorted(s)] == [0, *ends[:-1]] and (ends[-1] == 2048 or ends[-1] & (ends[-1] - 1) == 0)


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    docs(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_runs_and_keeps_columns(spark, sf_dir):
    import corpus_pipeline

    d = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = corpus_pipeline.run(spark, sf_dir).collect()
    assert {r["doc_id"] for r in rows} <= {r["doc_id"] for r in d.select("doc_id").collect()} and len(rows) > 50
    lengths = collections.Counter()
    for r in rows:
        lengths[r["sequence_id"]] += r["length"]
    assert all(n == 2048 or n & (n - 1) == 0 for n in lengths.values())
