"""Every training-data operator against brute force, with nulls, empty and long
texts, ties, repeated rows, empty tables and clashing columns."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quire.llm import (components, kneser_ney, mixing, neighbours, packing, pii, repeats, rules, simhash,
                       token_counts, warc)
from quire.llm.common import fresh, stored

WORD = re.compile(r"[^\x20\x09-\x0D]+")
EDGE = [(1, None, "en", "s1", 0), (2, "", "en", "s1", 0), (3, " \t\n", None, None, None), (4, "one", "de", "s2", 3),
        (5, "one", "de", "s2", 3), (5, "one", "de", "s2", 3), (6, "two words", "xx", "s2", 9), (None, "no id", "en", "s1", 5),
        (7, "word " * 30_000, "en", "s1", 150_000), (8, "é€漢😀 ÀB <|endoftext|> a", "fr", "s3", 20)]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def edge(spark):
    """Texts of all odd kinds, with extra columns whose names operators use themselves."""
    return spark.createDataFrame(EDGE, SCHEMA).withColumn("id", F.lit("x")).withColumn("n", F.lit(1)).withColumn("FP", F.lit(2))


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


def prose(seed, n, words=300):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefgé") for _ in range(r.randint(1, 8))) for _ in range(words)]
    return [" ".join(r.choice(vocabulary) for _ in range(r.randint(0, n))) for _ in range(200)]


def test_fresh_names_do_not_clash(edge):
    assert fresh(edge, "fp", "id", "other") == ["fp_", "id_", "other"]


# ---- 1 SimHash ---------------------------------------------------------------------------------

def brute_print(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    grams = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [" ".join(words)] * bool(words)
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def test_fingerprints_match_brute_force(edge):
    got = simhash.groups(edge).collect()
    expected = collections.Counter((r[0], brute_print(r[1])) for r in EDGE if r[0] != 7)
    assert collections.Counter((r.id, r.fp % (1 << 64)) for r in got if r.id != 7) == expected
    by_id = {r.id: r.group for r in got}
    assert by_id[1] == by_id[2] == by_id[3] == 1 and by_id[4] == by_id[5] == 4


def linked(fps):
    parent = {f: f for f in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    a = np.array(fps, dtype=np.int64).view(np.uint64)
    for i in range(len(fps)):
        for j in np.flatnonzero(np.bitwise_count(a[i] ^ a) <= 3):
            x, y = find(fps[i]), find(fps[int(j)])
            parent[max(x, y)] = min(x, y)
    return {f: find(f) for f in fps}


@pytest.mark.parametrize("cell", [16384, 32])
def test_links_reach_all_near_fingerprints(spark, monkeypatch, cell):
    monkeypatch.setattr(simhash, "CELL", cell)  # small: cells are dealt into parts
    r = random.Random(4)
    fps = set()
    for _ in range(60):
        base = r.getrandbits(64)
        for _ in range(25):
            fps.add(base)
            base ^= sum(1 << b for b in r.sample(range(64), r.choice([1, 2, 3, 5, 9])))
    fps = sorted(f - (1 << 64) if f >> 63 else f for f in fps)
    edges = simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long"))
    root = {x.node: x.root for x in components.components(edges).collect()}
    assert {f: root.get(f, f) for f in fps} == linked(fps)


def test_components_of_a_chain_a_star_and_nothing(spark):
    chain = [(i, i + 1) for i in range(100, 140)] + [(7, x) for x in range(8, 60)] + [(200, 200), (300, None)]
    got = {x.node: x.root for x in components.components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 100 for i in range(100, 141)}, **{i: 7 for i in range(7, 60)}}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_deduplicate_keeps_one_row_of_each_group(edge, empty):
    kept = simhash.deduplicate(edge)
    assert kept.columns == edge.columns
    groups = {r.group for r in simhash.groups(edge).collect()}
    assert collections.Counter(r.doc_id for r in kept.collect()) == collections.Counter(groups)
    assert simhash.deduplicate(empty).count() == 0


def test_deduplicate_keeps_different_texts_of_null_and_repeated_ids(spark):
    texts = [t for t in prose(21, 60) if len(t) > 60][:12]
    docs = [*[(None, t) for t in texts[:4]], (None, texts[0]), (1, texts[4]), (1, texts[5]), (1, texts[5]), (1, texts[0]),
            (2, texts[6]), (3, texts[6]), (3, texts[7]), (None, texts[7]), (-(1 << 63), texts[8]), (None, texts[8])]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    kept = sorted(map(tuple, simhash.deduplicate(df).collect()), key=repr)
    assert kept == sorted([*[(None, t) for t in texts[1:4]], (1, texts[4]), (1, texts[5]), (1, texts[0]), (2, texts[6]),
                           (3, texts[7]), (-(1 << 63), texts[8])], key=repr)


# ---- 2 packing ---------------------------------------------------------------------------------

def test_ids_equal_those_of_the_tokenizer():
    from tokenizers import Tokenizer
    encode, whole = packing.Encoder(*packing.vocabulary()), Tokenizer.from_file(packing.vocabulary()[0])
    r = random.Random(3)
    alphabet = "ab'sltremvd  \n\t\r\x0b\x1c\x1f\x85\xa0éñß²½µªº×÷_!.,#12\x00~¬’œ漢"
    for _ in range(3000):
        text = "".join(r.choice(alphabet) for _ in range(r.randint(0, 14)))
        assert encode(text).tolist() == whole.encode(text, add_special_tokens=False).ids + [1], text


@pytest.mark.parametrize("limits", [(2048, 64, 2047), (64, 3, 60), (128, 128, 20)])
def test_packer_places_every_token_once_within_the_limits(limits):
    r = random.Random(1)
    sizes = [r.choice([1, 2, 5, 100, 900, 1300, 3000]) for _ in range(800)]
    p = packing.Packer(*limits)
    for i, n in enumerate(sizes):
        p.place(i, n)
    p.finish()
    tokens, segments, loss, done = collections.Counter(), collections.Counter(), collections.Counter(), collections.Counter()
    for key, start, n, sequence, offset in p.out:
        assert offset == tokens[sequence] and start == done[key]
        tokens[sequence] += n
        segments[sequence] += 1
        loss[sequence] += n - 1
        done[key] += n
    assert [done[i] for i in range(len(sizes))] == sizes
    for used, limit in zip((tokens, segments, loss), limits, strict=True):
        assert max(used.values()) <= limit
    if limits[0] == 2048:
        padded = sum(n if n & (n - 1) == 0 else 2048 for n in tokens.values())
        assert sum(tokens.values()) / padded > 0.995


def test_pack_covers_each_document(edge, empty):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(packing.vocabulary()[0])
    rows = packing.pack(edge, *packing.vocabulary()).collect()
    by_doc = collections.defaultdict(list)
    for r in rows:
        by_doc[r.doc_id].append(r)
        assert zlib.crc32(np.array(r.ids, dtype="<u4").tobytes()) == r.ids_crc32 and len(r.ids) == r.length
    for key, text, *_ in EDGE:
        ids = whole.encode(text or "", add_special_tokens=False).ids + [1]
        pieces = sorted(by_doc[key], key=lambda x: x.start)
        copies = sum(e[0] == key for e in EDGE)
        assert sum(x.length for x in pieces) == copies * len(ids) and {x.doc_tokens for x in pieces} == {len(ids)}
        if copies == 1:
            assert [i for x in pieces for i in x.ids] == ids
    offsets = collections.defaultdict(list)
    for r in rows:
        offsets[r.sequence_id].append((r.offset, r.length))
    for places in offsets.values():
        places.sort()
        assert all(a + n == b for (a, n), (b, _) in zip(places, places[1:], strict=False)) and places[0][0] == 0
    assert packing.pack(empty, *packing.vocabulary()).count() == 0


@pytest.mark.parametrize("limits", [(2048, 64, 1024), (64, 5, 7), (256, 256, 1)])
def test_packer_keeps_the_loss_limit_of_masked_examples(limits):
    r = random.Random(7)
    sizes = [r.choice([1, 2, 5, 100, 900, 3000]) for _ in range(400)]
    masks = [None if i % 5 == 0 else np.array([r.random() < i % 7 / 6 for _ in range(n)]) for i, n in enumerate(sizes)]
    p = packing.Packer(*limits)
    for i, (n, m) in enumerate(zip(sizes, masks, strict=True)):
        p.place(i, n, None if m is None else packing._marked(m.tolist(), n))
    p.finish()
    used, done = collections.defaultdict(lambda: np.zeros(3, int)), collections.Counter()
    for key, start, n, sequence, offset in p.out:
        assert start == done[key] and offset == used[sequence][0]
        bears = n - 1 if masks[key] is None else int(masks[key][start + 1:start + n].sum())
        used[sequence] += (n, 1, bears)
        done[key] += n
    assert [done[i] for i in range(len(sizes))] == sizes
    assert (np.array(list(used.values())) <= limits).all()
    assert any(u[2] == limits[2] and u[0] < limits[0] and u[1] < limits[1] for u in used.values())  # it binds


def test_pack_takes_a_mask_of_each_example(spark):
    answers = [5, 400, 60, 1500, 0, 900]
    docs = [(i, "word " * 1200 * (i % 3 + 1), [False] * (1200 * (i % 3 + 1) - a) + [True] * a) for i, a in enumerate(answers)]
    df = spark.createDataFrame([*docs, (6, "one two", None), (7, "one two", [None])], "doc_id long, text string, m array<boolean>").repartition(1)
    masks = {d[0]: d[2] for d in docs} | {6: [], 7: [None]}
    loss, total = collections.Counter(), collections.Counter()
    for r in packing.pack(df, *packing.vocabulary(), loss="m").collect():
        m = [bool(x) for x in masks[r.doc_id]][:r.doc_tokens]
        marks = m + [True] * (r.doc_tokens - len(m))
        assert r.loss_tokens == sum(marks[r.start + 1:r.start + r.length])
        loss[r.sequence_id] += r.loss_tokens
        total[r.doc_id] += r.length
    assert len(total) == 8 and max(loss.values()) == packing.MASKED_LOSS


# ---- 3 repeated passages -----------------------------------------------------------------------

def brute_repeats(docs):
    first = {}
    for key, text in docs:
        b = (text or "").encode()
        at = -1 << 70 if key is None else key
        for s in range(len(b) - 99):
            w = b[s:s + 100]
            first[w] = min(first.get(w, (1 << 70, 0)), (at, s))
    out = []
    for key, text in docs:
        b = (text or "").encode()
        gone = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - 99):
            if first[b[s:s + 100]] < (-1 << 70 if key is None else key, s):
                gone[s:s + 100] = True
        gone = gone[:-1]
        runs = int((gone & ~np.concatenate([[False], gone[:-1]])).sum())
        left = bytes(x for x, g in zip(b, gone, strict=True) if not g)
        out.append((key, len(b), int(gone.sum()), runs, hashlib.sha256(left).hexdigest()))
    return out


def passages(seed=5):
    r = random.Random(seed)
    texts = prose(seed, 70)
    shared = [t for t in prose(seed + 1, 60) if len(t) > 120][:6]
    docs = []
    for i, t in enumerate(texts[:120]):
        for _ in range(r.randint(0, 3)):
            t += r.choice([" ", "\n", ""]) + r.choice(shared) + texts[r.randrange(200)][:r.randint(0, 40)]
        docs.append((i * 7 % 121, t))
    return docs + [(900, docs[3][1]), (901, docs[3][1][5:]), (902, "ab " * 200), (903, " " * 300), (904, None), (905, ""),
                   (None, docs[4][1]), (906, "x" * 99), (907, "x" * 250), (3, docs[3][1]), (3, docs[3][1])]


@pytest.mark.parametrize("hot", [8000, 3])
def test_removed_bytes_match_brute_force(spark, monkeypatch, hot):
    monkeypatch.setattr(repeats, "HOT", hot)  # small: anchors are taken apart into windows
    docs = passages()
    df = stored(spark.createDataFrame(docs, "doc_id long, text string").repartition(3).withColumn("rid", F.lit(1)), "t")
    got = sorted(map(tuple, repeats.remove(df).collect()), key=repr)
    assert got == sorted(brute_repeats([(r.doc_id, r.text) for r in df.collect()]), key=repr)


def test_removed_bytes_of_an_empty_table(empty):
    assert repeats.remove(empty).count() == 0


def test_long_texts_are_cut_into_slices_without_losing_windows(monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(repeats, "SLICE", 1000)
    text = prose(9, 900)[0] * 3
    batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([0]), pa.array([text])], names=["id", "rid", "text"])
    seen = collections.Counter()
    for raw, _, starts, shift, last in repeats._texts(batch, 2):
        number, lo, hi, _, _ = repeats.segments(raw, starts, last)
        for i, s, e in zip(number, lo, hi, strict=True):
            seen.update(range(s - starts[i] + shift[i], e - starts[i] + shift[i] + 1))
    assert seen == collections.Counter(range(len(text.encode()) - 99))


def test_suffix_array_borders_match_common_prefixes():
    r = random.Random(8)
    t = np.frombuffer(b"".join(bytes(r.choice(b"ab") for _ in range(40)) + b"\xff" for _ in range(30)), np.uint8)
    for depth in (3, 8, 12):
        sa = repeats.suffix_array(t, max(depth, 8))
        marked = repeats.common_borders(t, sa, depth)
        twice = t.tobytes() * 2
        for i in range(1, len(sa)):
            a, b = (twice[x:x + depth].split(b"\xff")[0] for x in (sa[i - 1], sa[i]))
            if a != b or len(a) == depth:  # what follows an end doesn't count
                assert marked[i] == (a != b)


# ---- 4 token counts ----------------------------------------------------------------------------

def greedy(word, start, rest):
    n, i, entries = 0, 0, start
    while i < len(word):
        for j in range(len(word), i, -1):
            if word[i:j] in entries:
                break
        else:
            return -1
        n, i, entries = n + 1, j, rest
    return n


@pytest.mark.parametrize("fallback", [True, False])
def test_automaton_counts_greedy_pieces(fallback):
    r = random.Random(1)
    for _ in range(60):
        start, rest = ([bytes(r.choice(b"abc") for _ in range(r.randint(1, 5))) for _ in range(r.randint(1, 12))] for _ in "12")
        auto = token_counts.Automaton(start, rest, fallback)
        single = [bytes([c]) for c in range(256)] if fallback else []
        words = [bytes(r.choice(b"abcd") for _ in range(r.randint(1, 30))) for _ in range(40)]
        raw = np.frombuffer(b" ".join(words), np.uint8)
        first, last, _ = token_counts.words(raw, np.array([0, len(raw)]))
        assert auto.pieces(raw, first, last).tolist() == [greedy(w, {*start, *single}, {*rest, *single}) for w in words]


def test_token_counts_of_texts(edge, empty):
    import public_tokenizers
    path = public_tokenizers.path("piece_bpe_32k.model")
    start, rest = token_counts.vocabulary(path)
    single = [bytes([c]) for c in range(256)]
    start, rest = {*start, *single}, {*rest, *single}
    got = collections.Counter((r.doc_id, r.n_words, r.n_tokens, r.n_unknown) for r in token_counts.with_counts(edge, path).collect())
    expected = []
    for key, text, *_ in EDGE:
        words = [w.encode() for w in WORD.findall(text or "")]
        known = {w: greedy(w, start, rest) for w in set(words)}
        expected.append((key, len(words), sum(known[w] for w in words), 0))
    assert got == collections.Counter(expected)
    assert token_counts.with_counts(empty, path).count() == 0


# ---- 5 personal data ---------------------------------------------------------------------------

def luhn(d):
    return sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(t):
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    return {"email": [m.span() for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)],
            "ip": [m.span() for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
                   if all(len(p.lstrip("0")) < 4 and int(p) <= 255 for p in m.group().split("."))],
            "card": [m.span() for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 13 <= len(digits(m)) <= 19 and luhn(digits(m))],
            "phone": [m.span() for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 9 <= len(digits(m)) <= 15]}


PERSONAL = [
    "a@b.c_d@e.f x 1.2.3.4 999.1.1.1 1.2.3.4.5.6.7.8 +1 (017) 555-7713 49 4417744280351547. card 4111-1111 1111 1111-9",
    "é +1 234 567 8901 é@x.y a.b@c.d.. IBAN GB82 WEST 1234 5698 7654 32 or GB82 WEST 1234 5698 7654 33",
    "SSN 123-45-6789, number 123-45-6789 far from any such word and more; call 555-123-4567, part 555-123-4567 of a list of parts",
    "1" * 20_000 + " " + "a" * 50_000 + "@" + "b." * 10_000 + "c" + " 1-1" * 10_000 + " 1.1.1.1" * 500, "4111111111111111", "", None]


def test_base_spans_match_plain_patterns(spark):
    r = random.Random(2)
    alphabet = ["1", "4111111111111111", "@", "a", ".", "-", " ", "+", "b.c", "12", "(", ")", "é", "0", "255", "_"]
    texts = PERSONAL + ["".join(r.choice(alphabet) for _ in range(r.randint(0, 60))) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in pii.digest(df).collect():
        spans = base_spans(texts[row.doc_id] or "")
        listed = ",".join(f"{k}:{a}:{b}" for k, v in spans.items() for a, b in v)
        assert [row.n_email, row.n_ip, row.n_card, row.n_phone] == [len(v) for v in spans.values()]
        assert row.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert row.spans.startswith(listed)


def test_checksums_and_context_decide_other_kinds(spark):
    df = spark.createDataFrame(list(enumerate(PERSONAL[:3])), "doc_id long, text string")
    found = {(r.doc_id, r.kind, r.value) for r in pii.find(df, keep=["doc_id"]).collect()}
    assert (1, "iban", "GB82 WEST 1234 5698 7654 32") in found
    assert not any(k == "iban" and v.endswith("33") for _, k, v in found)
    assert [v for _, k, v in found if k == "ssn"] == ["123-45-6789"]
    assert [v for _, k, v in found if k == "tel"] == ["555-123-4567"]


def test_redact_keeps_rows_and_columns(spark, edge, empty):
    out = pii.redact(edge)
    assert out.columns == edge.columns and out.count() == edge.count()
    assert {r.doc_id: r.text for r in out.collect() if r.doc_id != 7} == {r[0]: r[1] for r in EDGE if r[0] != 7}
    df = spark.createDataFrame([(1, "mail x@y.zz now, IP 1.2.3.4", 0)], "doc_id long, text string, n_chars long")
    row = pii.redact(df).first()
    assert row.text == "mail [EMAIL] now, IP [IP]" and row.n_chars == len(row.text)
    assert pii.redact(empty).count() == 0 and pii.digest(empty).count() == 0


# ---- 6 neighbours ------------------------------------------------------------------------------

def test_neighbours_reach_recall_with_exact_scores_and_ties(spark):
    r = np.random.default_rng(0)
    x = r.normal(size=(3000, 24))
    x[1000:1600] = x[999]  # a third of a task's rows are copies
    rows = [(i, v.tolist()) for i, v in enumerate(x)]
    rows += [(5000, None), (5020, [0.0] * 24), (5040, [float("nan")] * 24), (5060, [1.0, 2.0]), (5080, []), (5100, [None] * 24)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    usable = neighbours.usable(df, "vec_id", "embedding")
    assert usable.count() == 3000
    router = neighbours.fit(usable)
    got = collections.defaultdict(list)
    for q in neighbours.search(usable, usable.where("id % 20 = 0"), router, 20).orderBy("query_id", "rank").collect():
        got[q.query_id].append((q.vec_id, q.score))
    assert sorted(got) == list(range(0, 3000, 20))
    hits = []
    for q, found in got.items():
        score = np.zeros(3000)
        for j in range(24):
            score += x[:, j] * x[q, j]
        order = sorted((i for i in range(3000) if i != q), key=lambda i: (-score[i], i))[:20]
        assert len(found) == 20 and all(s == score[i] for i, s in found)
        assert found == sorted(found, key=lambda f: (-f[1], f[0]))
        hits.append(len(set(order) & {i for i, _ in found}) / 20)
    assert np.mean(hits) >= 0.9


def test_neighbours_of_few_and_no_vectors(spark):
    df = spark.createDataFrame([(0, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    rows = neighbours.usable(df, "vec_id", "embedding")
    found = {(r.query_id, r.rank): (r.vec_id, r.score) for r in neighbours.search(rows, rows.where("id % 20 = 0"), neighbours.fit(rows), 20).collect()}
    assert found == {(0, 1): (20, 1.0), (0, 2): (3, 0.0), (20, 1): (0, 1.0), (20, 2): (3, 0.0)}
    assert neighbours.fit(neighbours.usable(df.where("false"), "vec_id", "embedding")) is None


# ---- 7 Kneser-Ney ------------------------------------------------------------------------------

def brute_model(texts):
    s = kneser_ney.S
    top = collections.Counter()
    for t in texts:
        symbols = [0] * 3 + [int(kneser_ney.CLASSES[b]) for b in t.encode()]
        top.update(tuple(symbols[i - 3:i + 1]) for i in range(3, len(symbols)))
    levels = [top]
    for _ in range(3):
        levels.insert(0, collections.Counter(g[1:] for g in levels[0]))
    discounts = []
    for c in levels:
        n = [sum(v == i for v in c.values()) for i in range(1, 5)]
        y = n[0] / max(1, n[0] + 2 * n[1])
        discounts.append([min(max(i + 1 - (i + 2) * y * n[i + 1] / max(1, n[i]), 0.1), i + 0.9) for i in range(3)])

    def p(gram):
        if not gram:
            return 1 / s
        c, d = levels[len(gram) - 1], discounts[len(gram) - 1]
        same = {g: v for g, v in c.items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        total = sum(same.values())
        cut = {g: d[min(v, 3) - 1] for g, v in same.items()}
        seen = (same[gram] - cut[gram]) / total if gram in same else 0
        return seen + sum(cut.values()) / total * p(gram[1:])
    return p


def test_model_matches_the_textbook_formula(spark):
    texts = prose(11, 12)[:20] + ["", "Ab, cd!"]
    bits = kneser_ney.model(spark.createDataFrame([(t,) for t in texts] + [(None,)], "text string"))
    p = brute_model(texts)
    s = kneser_ney.S
    r = random.Random(0)
    grams = [(4, 5, 6, 7), (0, 0, 0, 4), (0, 0, 0, 3)] + [tuple(r.randrange(s) for _ in range(4)) for _ in range(30)]
    for g in grams:
        code = ((g[0] * s + g[1]) * s + g[2]) * s + g[3]
        assert 2 ** -float(bits[code]) == pytest.approx(p(g), rel=1e-4)
    assert (2 ** -bits.astype(float)).reshape(-1, s).sum(axis=1) == pytest.approx(1, abs=1e-3)


def test_quality_keeps_clean_and_rejects_junk(spark, edge, empty):
    good = [(i, t + " and so it goes on for some words more.", "en", 1) for i, t in enumerate(prose(3, 60, 80))]
    junk = [(1000 + i, "### %% " * 40 + str(i), "en", 0) for i in range(10)]
    docs = spark.createDataFrame([(i, t, g, "s", len(t)) for i, t, g, _ in good + junk], SCHEMA)
    labels = spark.createDataFrame([(i, q, 0) for i, _, _, q in good[:150] + junk[:5]] + [(None, None, None)],
                                   "doc_id long, quality int, toxic int")
    kept = {r.doc_id for r in kneser_ney.keep_good(spark, docs, labels).collect()}
    assert not any(i >= 1000 for i in kept) and len(kept) >= 195
    none = labels.where("false")
    assert {r.doc_id for r in kneser_ney.keep_good(spark, edge, none).collect()} == {r[0] for r in EDGE if r[1]}
    assert kneser_ney.keep_good(spark, edge, labels).columns == edge.columns
    assert kneser_ney.keep_good(spark, empty, labels).count() == 0


def test_each_language_has_its_own_limit(spark):
    """A language whose trusted texts are all alike is judged by their narrow spread, though another's is wide."""
    r = random.Random(5)
    letters = lambda pool, n: " ".join("".join(r.choice(pool) for _ in range(r.randrange(3, 7))) for _ in range(n))
    narrow = [(i, " ".join(r.choice(["salo", "mira", "tole", "rane"]) for _ in range(80)), "aa") for i in range(1200)]
    wide = [(5000 + i, letters("abcdefghij"[:r.randrange(2, 10)], 80), "bb") for i in range(1200)]
    few = [(9000 + i, d[1], g) for i, (d, g) in enumerate((d, g) for d in [*narrow[:3], *wide[:3]] for g in ("cc", None))]
    wrong = [(7000 + i, letters("salomirtne", 80), "aa") for i in range(20)]  # wrong words of the same letters
    docs = spark.createDataFrame([(*d[:2], d[2], "s", 1) for d in narrow + wide + few + wrong], SCHEMA)
    labels = spark.createDataFrame([(d[0], 1, 0) for d in narrow + wide + few[:6]], "doc_id long, quality int, toxic int")
    scored, (limits, every), _ = kneser_ney.fit(spark, docs, labels)
    of = {x.lang: x for x in limits.collect()}
    assert {"aa", "bb"} <= set(of) and of["aa"].limit < of["bb"].limit
    assert all(of[g].limit == every["limit"] for g in of if g not in ("aa", "bb"))  # too few for a quantile of their own
    verdict = {x.id: x.kept for x in kneser_ney.judged(scored, (limits, every), "lang", "bits", "n").collect()}
    assert len(verdict) == len(narrow) + len(wide) + len(few) + len(wrong)
    assert not any(verdict[d[0]] for d in wrong)
    assert sum(verdict[d[0]] for d in narrow) >= 1190 and sum(verdict[d[0]] for d in wide) >= 1190
    unknown = spark.createDataFrame([(1, narrow[0][1], "zz")], "id long, text string, lang string")  # a language without labels
    assert kneser_ney.judged(unknown.selectExpr("id", "lang", "300D bits", "300L n"), (limits, every), "lang", "bits", "n").count() == 1


def brute_bits(train, text, of, size, order):
    """Bits of ``text`` by a textbook model over n-grams as tuples."""
    line = lambda t: [int(of[10])] * (order - 1) + [int(of[b]) for b in t.encode()]
    cut_up = lambda t: [tuple(x[i - order + 1:i + 1]) for x in [line(t)] for i in range(order - 1, len(x))]
    levels = [collections.Counter(g for t in train for g in cut_up(t))]
    for _ in range(order - 1):
        levels.insert(0, collections.Counter(g[1:] for g in levels[0]))

    def p(gram):
        if not gram:
            return 1 / size
        c = levels[len(gram) - 1]
        n = [sum(v == i for v in c.values()) for i in range(1, 5)]
        y = n[0] / max(1, n[0] + 2 * n[1])
        d = [min(max(i + 1 - (i + 2) * y * n[i + 1] / max(1, n[i]), 0.1), i + 0.9) for i in range(3)]
        same = {g: v for g, v in c.items() if g[:-1] == gram[:-1]}
        if not same:
            return p(gram[1:])
        seen = same[gram] - d[min(same[gram], 3) - 1] if gram in same else 0
        return (seen + sum(d[min(v, 3) - 1] for v in same.values()) * p(gram[1:])) / sum(same.values())
    return -sum(np.log2(p(g)) for g in cut_up(text))


@pytest.mark.parametrize("symbols", [kneser_ney.BYTES, kneser_ney.LETTERS], ids=["bytes", "letters"])
def test_texts_are_scored_by_joins_with_the_counts(spark, monkeypatch, symbols):
    train = prose(11, 12)[:12] + ["", "Ab, cd! 17", "да нет да"]
    texts = [train[0], "zq " + train[1][:40], "нет, ж\n", "", None, "Ab, cd! 93", "Ab, cd! 93"]
    docs = spark.createDataFrame([(i % 6, t, {"k": 1}) for i, t in enumerate(texts)], "id long, text string, more map<string,int>")
    model = kneser_ney.levels(kneser_ney.stored(kneser_ney.counts(
        spark.createDataFrame([(t,) for t in train], "text string"), symbols=symbols), "kn"), symbols)

    def never(*_):
        raise AssertionError("no model goes to every task or to the driver")
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", never)
    monkeypatch.setattr(kneser_ney.DataFrame, "toPandas", never)
    monkeypatch.setattr(kneser_ney, "BLOCK", 50)  # several blocks
    found = kneser_ney.with_bits(docs, model, "text", "bits", "n", symbols=symbols).collect()
    assert sorted((r.id, r.text) for r in found if r.id) == sorted((i % 6, t) for i, t in enumerate(texts) if i % 6)
    assert len(found) == len(texts) and all(r.more == {"k": 1} for r in found)
    for r in found:
        assert r.n == len((r.text or "").encode())
        assert r.bits == pytest.approx(brute_bits(train, r.text or "", *symbols), rel=1e-4)


def test_bytes_of_one_class_are_told_apart(spark):
    """Letters of other scripts, capitals and marks that fall into one class of LETTERS."""
    known, other = "жук НАД Abc; ", "иук УАД Xyz! "
    letters = kneser_ney.CLASSES
    assert (letters[list("Abc;".encode())] == letters[list("Zbc!".encode())]).all()
    docs = spark.createDataFrame([(i, (known if i < 300 else other) * 5, "ru", "s", 1) for i in range(302)], SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(300)], "doc_id long, quality int, toxic int")
    scored, limits, _ = kneser_ney.fit(spark, docs, labels)
    kept = {r.id: r.kept for r in kneser_ney.judged(scored, limits, "lang", "bits", "n").collect()}
    assert all(kept[i] for i in range(300)) and not kept[300] and not kept[301]


# ---- 8 rules -----------------------------------------------------------------------------------

def brute_counts(text):
    t = text or ""
    words, lines = WORD.findall(t), [x for x in t.split("\n") if WORD.search(x)]
    windows = collections.Counter(tuple(words[i:i + 5]) for i in range(len(words) - 4))
    inside = {j for i in range(len(words) - 4) if windows[tuple(words[i:i + 5])] > 1 for j in range(i, i + 5)}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(inside))


def test_counts_match_brute_force(spark, edge, empty):
    r = random.Random(6)
    texts = ["".join(r.choice(["a", "b ", "é", "\n", " ", "#", "c\t", "|", "X"]) for _ in range(r.randint(0, 120))) for _ in range(200)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for row in rules.measure(df).collect():
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_dup_lines, row.n_repeat_words) == brute_counts(texts[row.id])
    got = collections.Counter((x.id, x.n_words) for x in rules.measure(edge).collect())
    assert got == collections.Counter((e[0], brute_counts(e[1])[0]) for e in EDGE)
    assert rules.judge(stored(rules.measure(empty), "t")).count() == 0


def test_accuracies_are_recovered_without_labels():
    r = np.random.default_rng(1)
    truth = r.random(40_000) < 0.8
    right = np.array([0.95, 0.9, 0.85, 0.7])
    votes = np.where(r.random((40_000, 4)) < right, np.where(truth, 1, -1)[:, None], np.where(truth, -1, 1)[:, None])
    votes[r.random(votes.shape) < 0.2] = 0
    patterns, inverse, counts = np.unique(votes, axis=0, return_inverse=True, return_counts=True)
    post, accuracy, share = rules.estimate(patterns, counts.astype(float))
    assert np.abs(accuracy - right).max() < 0.05 and abs(share - 0.8) < 0.03
    assert ((post[inverse.reshape(-1)] >= 0.5) == truth).mean() > 0.93


# ---- 9 WARC ------------------------------------------------------------------------------------

def test_archives_round_trip_with_magic_inside_payloads(spark, tmp_path):
    trap = "WARC/1.1\r\nWARC-Type: response\r\nContent-Length: 10\r\n\r\n0123456789\r\n\r\nWARC/1.0\r\n\r\n WARC/1."
    big = "é" * 600
    pages = [(1, "http://a/ b\r\nX: y", trap), (2, None, None), (3, "u", ""), (4, "u", trap * 40), (5, "u", big), (9, "u", big), (7, "u", big),
             (8, "u", "x" * 999), (10, "u", "x" * 999), (None, "u", big), (11, "u", "\r\n\r\nWARC/1.1\r\n" + "z" * 300_000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(2)
    for kind in ("none", "gzip"):
        path = str(tmp_path / kind)
        warc.write(df, path, compression=kind)
        old = spark.conf.get("spark.sql.files.maxPartitionBytes")
        spark.conf.set("spark.sql.files.maxPartitionBytes", "3k")  # records cross the ranges
        try:
            got = {r.page_id: r for r in warc.digests(warc.read(spark, path)).collect()}
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        assert len(got) == len(pages)
        for key, _, html in pages:
            body = (html or "").encode()
            again = html == big and key != 9
            assert (got[key].payload_bytes, got[key].payload_digest) == (len(body), hashlib.sha1(body).hexdigest())
            assert (got[key].record_type, got[key].refers_to) == (("revisit", 9) if again else ("response", None))


def test_archives_round_trip_with_magic_in_headers(spark, tmp_path):
    pages = [(i, f"http://h/{i}" + ("/WARC/1.1/WARC/1.0?x" if i % 3 == 1 else ""), f"page {i} " * i) for i in range(1, 13)]
    warc.write(spark.createDataFrame(pages, "page_id long, url string, html string").repartition(1), str(tmp_path / "w"))
    found = warc.read(spark, str(tmp_path / "w"))
    got = {r.page_id: r.payload_digest for r in warc.digests(found).collect()}
    assert got == {i: hashlib.sha1(html.encode()).hexdigest() for i, _, html in pages}
    assert {r.target_uri.replace("%2E", ".") for r in found.collect()} == {url for _, url, _ in pages}


def test_foreign_archives_with_magic_in_headers(spark, tmp_path):
    def record(i, url, body, at_end=""):
        return (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:{i}>\r\nWARC-Target-URI: {url}\r\n"
                f"Content-Length: {len(body)}{at_end}\r\n\r\n").encode() + body + b"\r\n\r\n"

    trap = b"WARC/1.1\r\nContent-Length: 3"  # no blank line: its header would end in a later record
    bodies = [b"one", trap, b"three", b"", trap * 3 + b"\r\n\r\nx", b"six"]
    urls = ["u", "WARC/1.0/WARC/1.1", "u", "x WARC/1.", "WARC/1.WARC/1.", "u"]
    ends = ["", "\r\nX: WARC/1.", "\r\nContent-Length: 9WARC/1.", "", "\r\nWARC/1.: \r\nY: y", ""]
    (tmp_path / "a.warc").write_bytes(b"".join(record(i, *x) for i, x in enumerate(zip(urls, bodies, ends, strict=True))))
    got = {r.record_id: (r.target_uri, bytes(r.payload)) for r in warc.read(spark, str(tmp_path / "a.warc")).collect()}
    assert got == {f"<urn:page:{i}>": x for i, x in enumerate(zip(urls, bodies, strict=True))}


def test_archive_of_no_pages(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    warc.write(empty, str(tmp_path / "w"))
    assert warc.digests(warc.read(spark, str(tmp_path / "w"))).count() == 0


# ---- 10 mixing ---------------------------------------------------------------------------------

def fill(budget, children):
    """{name: (capacity, weight)} -> shares: weights meet, shortages go to siblings."""
    out, live = {}, dict(children)
    while live:
        w = sum(v[1] for v in live.values())
        full = {k: v for k, v in live.items() if v[0] < budget * v[1] / w}
        if not full:
            out |= {k: budget * v[1] / w for k, v in live.items()}
            break
        for k, v in full.items():
            out[k] = v[0]
            budget -= v[0]
            del live[k]
    return out


@pytest.mark.parametrize("share", [30, 100, 250, 1000])
def test_mix_matches_a_direct_computation(spark, share):
    r = random.Random(share)
    docs = [(i, "w " * r.randint(0, 40), r.choice(["en", "de"]), r.choice(["a", "a", "a", "b", "c"]), 0) for i in range(400)]
    docs += [(401, None, None, None, None), (402, "", "en", "a", 0), (403, "x y", "en", None, 3)]
    df = spark.createDataFrame(docs, SCHEMA).withColumn("mix_epoch", F.lit("own"))
    levels = {"lang": "lang", "source": "source"}
    weights = {"lang": {"en": 0.7, "de": 0.3}, "source": {"a": 1, "b": 2, "c": 3}}
    out, h = mixing.mix(df, levels, weights, share=share, max_epochs=3)
    assert len(set(out.columns)) == len(out.columns)
    got = collections.Counter((x.doc_id, x[h[-2]]) for x in out.collect())
    tokens = {d[0]: len((d[1] or "").split()) for d in docs}
    leaves = collections.defaultdict(list)
    for d in docs:
        leaves[d[2] or "", d[3] or ""].append(d[0])
    size = {k: sum(tokens[i] for i in v) for k, v in leaves.items()}
    langs = {g for g, _ in leaves}
    top = fill(sum(size.values()) * share / 100, {g: (3 * sum(v for k, v in size.items() if k[0] == g), weights["lang"].get(g, 1)) for g in langs})
    expected = collections.Counter()
    for g in langs:
        for s, budget in fill(top[g], {k[1]: (3 * v, weights["source"].get(k[1], 1)) for k, v in size.items() if k[0] == g}).items():
            ids, budget = leaves[g, s], int(budget + 1e-6)
            full = budget // size[g, s] if size[g, s] else 0
            left = budget - full * size[g, s]
            for e in range(full):
                expected.update((i, e) for i in ids)
            order = sorted(ids, key=lambda i: hashlib.md5(f"{mixing.SEED}:{full}:{i}".encode()).hexdigest())
            for i in order if left else []:
                left -= tokens[i]
                if left < 0:
                    break
                expected[i, full] += 1
    assert got == expected


def test_mix_of_nothing(empty):
    assert mixing.mix(empty)[0].count() == 0
