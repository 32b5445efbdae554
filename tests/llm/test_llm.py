"""Each operator against brute force, an exact round trip or held-out accuracy, and on edge rows."""

import hashlib
import random
import re
import textwrap
import time
from collections import defaultdict

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from compare import duck, duck_rows, spark_rows
from ledgerlens.llm import bpe, chunks, decontaminate, fingerprint, jaccard, langid, licences, quality, sharding, warc
from ledgerlens.llm.graph import components
from ledgerlens.llm.queries import ORACLE, QUERIES, vocabulary_path
from ledgerlens.scratch import durable

SF = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}
DOC = "doc_id long, text string, lang string, source string, n_chars long, x double, `__key` string"
LONG = " ".join(f"w{i % 977}q{i}" for i in range(60_000))


def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, None, len(t or ""), 0.5, "k") for i, t in texts], DOC)


@pytest.fixture(scope="module")
def edge(spark):
    texts = ["", None, " \n", "a", "one two three", LONG, LONG, "the same text of some words here", "é\U0001f600 <|endoftext|> x"]
    return docs(spark, [*enumerate(texts), (7, texts[7]), (None, "without id, a few words of text"), (None, None)])


@pytest.fixture(scope="module")
def empty(spark):
    return docs(spark, [])


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    return frozenset(tuple(w[i : i + 5]) for i in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def linked_components(rows):
    sets = [(d, shingles(t)) for d, t in rows]
    parent = {d: d for d, _ in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    holders = defaultdict(list)
    for k, (d, s) in enumerate(sets):
        near = defaultdict(int)
        for t in s:
            for j in holders[t]:
                near[j] += 1
            holders[t].append(k)
        for j, c in near.items():
            if 100 * c >= 75 * (len(s) + len(sets[j][1]) - c):
                a, b = find(d), find(sets[j][0])
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), find(d)) for d, s in sets}


def table(df):
    return [(r.doc_id, r.text) for r in df.select("doc_id", "text").collect()]


def test_jaccard_components_are_those_of_all_pairs(spark):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in QUERIES["op3_jaccard"](spark, SF).collect()}
    assert got == linked_components(table(source))


def test_jaccard_of_a_chain_of_near_copies(spark):
    base = [f"word{i}" for i in range(120)]
    rows = []
    for i in range(60):
        w = list(base)
        for j in range(0, i, 2):
            w[j * 2] = f"edit{i // 3}x{j}"
        rows.append((i, " ".join(w)))
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.similarity_components(docs(spark, rows)).collect()}
    assert got == linked_components(rows)


def test_jaccard_agrees_with_sql(spark):
    assert spark_rows(QUERIES["op3_jaccard"](spark, SF)) == duck_rows(duck(SF), ORACLE["op3_jaccard"])


def test_jaccard_layers_of_common_shingles_change_no_result(spark):
    line = "a passage of ten words that many of these share"
    rows = [(i, " ".join([line, *(f"own{i // 3}x{j}" for j in range(12)), f"last{i}"])) for i in range(90)]
    rows += [(100 + i, f"{line} {'tail ' * (i % 4)}".strip()) for i in range(8)]
    source = docs(spark, rows)
    sets = durable(jaccard.shingle_sets(source, sampled=1))
    assert len(jaccard._common(sets, 50)) == 6
    own = {r.id: r.set_id for r in sets.collect()}
    found = []
    for least in (1 << 40, 50, 2):
        got = {r.node: r.comp for r in jaccard.set_components(source, sets, common_sampled=least, layer_sets=9).collect()}
        groups = defaultdict(set)
        for d, s in own.items():
            groups[got.get(s, s)].add(d)
        found.append({frozenset(g) for g in groups.values()})
    expected = defaultdict(set)
    for d, (_, c) in linked_components(rows).items():
        expected[c].add(d)
    assert found == [{frozenset(g) for g in expected.values()}] * 3


def test_jaccard_edges(edge, empty):
    got = {(r.doc_id, r.n_shingles, r.component_id) for r in jaccard.similarity_components(edge).collect()}
    assert {(0, 0, 0), (1, 0, 1), (2, 0, 2), (3, 1, 3), (4, 1, 4), (7, 3, 7), (None, 3, None), (None, 0, None)} <= got
    assert {c for d, _, c in got if d in (5, 6)} == {5}
    assert jaccard.similarity_components(empty).count() == 0


def test_components_of_a_path(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(30)] + [(100, 101)], "x long, y long")
    got = {r.node: r.comp for r in components(links).collect()}
    assert got == {**dict.fromkeys(range(31), 0), 100: 100, 101: 100}


def test_bpe_agrees_with_the_library(spark, edge, empty):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    source = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").union(edge.select("doc_id", "text"))
    out = bpe.encode_documents(source, vocabulary_path(), keep=("text",), outputs=("token_ids", "decoded", "ids_sha256", "round_trip"))
    for r in out.collect():
        ids = t.encode(r.text or "", add_special_tokens=False).ids
        assert r.token_ids == ids
        assert r.decoded == t.decode(ids, skip_special_tokens=False) and r.round_trip
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
    assert bpe.encode_documents(empty, vocabulary_path()).count() == 0


def test_bpe_long_and_short_words_take_the_same_merges():
    with open(vocabulary_path(), encoding="utf-8") as file:
        v = bpe.Vocabulary(file.read())
    for word in (b"antidisestablishmentarianism" * 4, b"\xff\xfe aaaa" * 9, "ééé".encode() * 20):
        assert v._scan(word) == v._heap(word)


def test_bpe_remembered_words_are_bounded_in_bytes(monkeypatch):
    with open(vocabulary_path(), encoding="utf-8") as file:
        v = bpe.Vocabulary(file.read())
    text = " ".join(f"word{i}" for i in range(2000))
    ids = v.encode(text)
    assert len(v.cache) + len(v.after_space) >= 3999
    monkeypatch.setattr(bpe, "CACHED_BYTES", 20_000)
    v.forget()
    assert v.encode(text) == ids and v.decode(ids) == text
    assert len(v.cache) + len(v.after_space) <= 20_000 // bpe.CACHED_WORD_BYTES
    v.forget()
    assert not v.cache and not v.after_space and v.cached_bytes == 0


@pytest.mark.parametrize("characters", [1 << 20, 500, 7])
def test_bpe_many_texts_together_agree_with_the_library(monkeypatch, characters):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(vocabulary_path())
    with open(vocabulary_path(), encoding="utf-8") as file:
        v = bpe.Vocabulary(file.read())
    units = ["a", "The", "ing", "é", "日本", "\U0001f600", "7", "²", "Ⅷ", "\u0301", " ", "  ", "\n", "\t", "\u00a0", "\x85", "\u3000",
             "'", "'s", "'S", "'re", "'ll", "'l", "'v", "!", "?", "<|endoftext|>", "<|endof", "x" * 64, "ab" * 33]
    rng = random.Random(4)
    texts = ["", "'", " ", "a ", "<|endoftext|>", "<|endoftext|><|endoftext|>'s", *("".join(rng.choices(units, k=rng.randrange(30))) for _ in range(3000))]
    monkeypatch.setattr(bpe, "SLICE_CHARACTERS", characters)
    monkeypatch.setattr(bpe, "MERGED_CELLS", 200)
    ids, bounds = v.encode_all(texts)
    expected = [t.encode(text, add_special_tokens=False).ids for text in texts]
    assert [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:])] == expected == [*map(v.encode, texts)]
    assert v.decode_all(ids, bounds) == texts
    assert v.digests(ids, bounds) == [hashlib.sha256(",".join(map(str, e)).encode()).hexdigest() for e in expected]
    assert [len(x) for x in v.encode_all([])] == [0, 1]


def test_bpe_distinct_short_words_are_not_merged_one_by_one(spark, monkeypatch):
    """Words that seldom repeat: what a task remembers is of no help."""
    rng = random.Random(5)
    texts = [" ".join("".join(rng.choices("abcdeghilmnorstu", k=9)) for _ in range(2000)) for _ in range(30)]
    texts.append("y" * 65 + " z")
    with open(vocabulary_path(), encoding="utf-8") as file:
        v = bpe.Vocabulary(file.read())
    expected = [*map(v.encode, texts)]
    merged = []
    monkeypatch.setattr(bpe.Vocabulary, "merge_word", lambda v, word, own=bpe.Vocabulary.merge_word: merged.append(word) or own(v, word))
    bpe._vocabulary.cache_clear()
    monkeypatch.setattr(bpe.SparkFiles, "get", lambda name: vocabulary_path())
    run = []  # the operator's own function, called here
    df = docs(spark, [(i, t) for i, t in enumerate(texts)]).select("doc_id", "text")
    monkeypatch.setattr(type(df), "mapInArrow", lambda self, f, schema: run.append(f))
    bpe.encode_documents(df, vocabulary_path())
    batch = pa.RecordBatch.from_pydict({"c0": [*range(len(texts))], "text": texts})
    (out,) = run[0](iter([batch]))
    assert out.column(1).to_pylist() == expected and out.column(3).to_pylist() == texts
    assert merged == [b"y" * 65]


def test_fingerprints(spark, edge, empty):
    got = {r.doc_id: r for r in QUERIES["op5_fingerprints"](spark, SF).collect()}
    rows = sorted(table(spark.read.parquet(f"{SF}/documents.parquet")), reverse=True)
    for k, (d, text) in enumerate(rows):
        following = rows[(k + 1) % len(rows)][1]
        cut = len(text) // 3
        new = text[: len(text) - cut] + following[:cut] if cut else text
        r = got[d]
        a, b, c = (fingerprint.digest(x.encode()) for x in (text, new, following))
        assert (r.n_chars, r.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (r.fingerprint, r.edited_fingerprint) == (fingerprint.written(a), fingerprint.written(b))
        assert (r.near_edited, r.near_next) == (fingerprint.likeness(a, b), fingerprint.likeness(a, c))
    assert fingerprint.fingerprints(edge).count() == edge.count()
    assert fingerprint.fingerprints(empty).count() == 0
    assert fingerprint.fingerprints(edge.where("doc_id = 3")).first().near_next == 1.0


def test_shards_are_even_gapless_and_keep_copies_together(spark, edge, empty):
    rows = QUERIES["op6_sharding"](spark, SF).collect()
    text = dict(table(spark.read.parquet(f"{SF}/documents.parquet")))
    slots, groups = defaultdict(list), defaultdict(set)
    for r in rows:
        slots[r.shard].append(r.slot)
        groups[text[r.doc_id]].add(r.shard)
        assert r.size == len(text[r.doc_id].encode()) + 1
    sizes = [len(s) for s in slots.values()]
    assert len(slots) == 16 and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == [*range(len(s))] for s in slots.values())
    assert all(len(s) == 1 for s in groups.values())
    assert sharding.shard_documents(edge).count() == edge.count()
    assert sharding.shard_documents(empty).count() == 0


def test_a_group_larger_than_a_shard_fills_shards(spark):
    big = docs(spark, [(i, "copy" if i % 3 == 0 else f"own {i}") for i in range(320)])
    rows = sharding.shard_documents(big).collect()
    sizes, held = defaultdict(int), defaultdict(int)
    for r in rows:
        sizes[r.shard] += 1
        held[r.shard] += r.n_copies > 1
    assert set(sizes.values()) == {20} and sum(held.values()) == 107
    assert sum(1 for n in held.values() if n) <= 9


@pytest.mark.parametrize("sizes", [[2] * 800, [2] * 500 + [1] * 600, [10] * 152 + [2] * 40, [1500, *[2] * 50]])
def test_copies_share_a_shard_where_all_or_nearly_all_rows_have_copies(spark, sizes):
    texts = [f"text {k}" for k, n in enumerate(sizes) for _ in range(n)]
    rows = sharding.shard_documents(docs(spark, list(enumerate(texts)))).collect()
    held, full = defaultdict(set), defaultdict(int)
    for r in rows:
        held[texts[r.doc_id]].add(r.shard)
        full[r.shard] += 1
    assert len(rows) == 1600 and set(full.values()) == {100}
    assert all(len(held[f"text {k}"]) == 1 for k, n in enumerate(sizes) if n <= 100)


def test_cut_links_fall_from_round_to_round(spark):
    rounds: list[tuple[int, int, int]] = []
    texts = [f"text {k}" for k in range(400) for _ in range(2 + k % 3)]
    rows = sharding.shard_documents(docs(spark, [*enumerate(texts)]), shards=4, history=rounds).collect()
    cut = [c for _, _, c in rounds]
    assert len(rows) == len(texts) and cut[0] > 1_000 and rounds[0][1] > 400
    assert all(b <= a for a, b in zip(cut, cut[1:])) and cut[-2] < 0.2 * cut[0] and cut[-1] <= 0.01 * cut[0]
    rounds = []
    known = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    sharding.shard_documents(known, history=rounds)
    assert rounds[0][1] > 0 and rounds[0][2] > rounds[-1][2] == 0


def test_propagation_swaps_where_no_shard_has_room(spark):
    given = sharding._grants({(0, 1): 5, (1, 0): 3, (2, 0): 4}, [0, 2, 0])
    assert given == {(0, 1): 5, (1, 0): 3, (2, 0): 2}
    links = [(i, f"a{i // 2}") for i in range(64)] + [(i, f"b{(i + 1) % 64 // 2}") for i in range(64)]
    got = sharding.propagate(spark.createDataFrame(links, "node long, grp string"), [16] * 4).collect()
    assert sorted(r.node for r in got) == [*range(64)]
    assert {s: sum(r.shard == s for r in got) for s in range(4)} == {s: 16 for s in range(4)}


def test_decontamination_finds_what_all_windows_hold(spark, edge, empty):
    bench = spark.read.parquet(f"{SF}/benchmark.parquet")
    split = lambda t: re.findall(r"[^\W_]+", (t or "").lower())
    items = {r.item_id: split(r.text) for r in bench.collect()}
    expected = set()
    rows = table(spark.read.parquet(f"{SF}/documents.parquet"))
    for d, text in rows:
        w = split(text)
        mine = {tuple(w[i : i + 5]) for i in range(len(w) - 4)}
        for item, v in items.items():
            if mine & {tuple(v[i : i + 5]) for i in range(len(v) - 4)}:
                weights = decontaminate._counted
                import numpy as np

                number = {g: i for i, g in enumerate(mine | {tuple(v[i : i + 5]) for i in range(len(v) - 4)})}
                of = lambda x: weights(np.array([number[tuple(x[i : i + 5])] for i in range(len(x) - 4)]))
                n = min(len(v), len(w))
                best = max(decontaminate.weighted_similarity(of(w[i : i + n]), of(v)) for i in range(len(w) - n + 1))
                if best >= 0.75:
                    expected.add((d, item, round(best, 9)))
    got = {(r.doc_id, r.item_id, round(r.similarity, 9)) for r in QUERIES["op7_decontaminate"](spark, SF).collect()}
    assert got == expected and expected
    assert decontaminate.contaminated(edge, bench).count() == 0
    assert decontaminate.contaminated(empty, bench).count() == decontaminate.contaminated(edge, bench.limit(0)).count() == 0


def test_chunks_resist_an_insertion_and_lose_repeats(spark, edge, empty):
    import numpy as np

    body = " ".join(f"tok{i * 7919 % 4001}" for i in range(900))
    data = body.encode()
    of = lambda d: {d[a : a + n] for _, a, n, _ in zip(*chunks.chunks(np.frombuffer(d, np.uint8), [0, len(d)]))}
    changed = of(data[:3000] + b"inserted" + data[3000:])
    assert len(of(data) - changed) < 12 and len(of(data)) > 100
    points = chunks.cuts(np.frombuffer(data, np.uint8), np.array([0, len(data)]))
    assert points[0] == 0 and points[-1] == len(data) and 20 < len(data) / len(points) < 32
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = [(1, f"first {passage} end"), (2, f"xx {body[:3000]} {passage} {body[3000:]}"), (3, f"yy {passage}"), (4, body)]
    got = {r.doc_id: r for r in chunks.drop_repeated_substrings(docs(spark, rows)).collect()}
    assert got[1].text == rows[0][1]
    assert all(" ".join(f"shared{i}" for i in range(5, 55)) not in got[i].text for i in (2, 3))
    assert got[4].cut_bytes > 0.8 * len(body)
    for i, text in rows:
        left, at = b"", 0
        for s in got[i].cut_spans:
            left += text.encode()[at : s.start]
            at = s.end
        assert (left + text.encode()[at:]).decode() == got[i].text
    kept = {(r.doc_id, r.text) for r in chunks.drop_repeated_substrings(edge).collect()}
    assert {(0, ""), (1, None), (5, LONG), (6, ""), (None, None)} <= kept
    assert chunks.drop_repeated_substrings(empty).count() == 0


def test_no_repeated_passage_of_51_words_is_left(spark):
    words = [w for _, t in table(spark.read.parquet(f"{SF}/documents.parquet")) for w in t.split() if len(w) > 1]
    draw = random.Random(8)
    prose = lambda n: " ".join(draw.choices(words, k=n))
    passages = [prose(51) for _ in range(150)]
    rows = [(i, f"{prose(90)} {p} {prose(90)}") for i, p in enumerate(passages * 2)]
    got = {r.doc_id: r.text for r in chunks.drop_repeated_substrings(docs(spark, rows)).collect()}
    windows = lambda t: {tuple(t.split()[i : i + 51]) for i in range(len(t.split()) - 50)}
    seen, left = set(), 0
    for i, _ in rows:
        own = windows(got[i])
        left += len(seen & own)
        seen |= own
    assert left == 0
    assert [got[i] for i in range(150)] == [t for _, t in rows[:150]]
    # All bytes of the passage go, and no more than chance agreement of the neighbours.
    assert all(len(rows[i][1].encode()) - len(got[i].encode()) - len(passages[i - 150].encode()) in range(20) for i in range(150, 300))
    periodic = "".join(["word " * 400, "x" * 700, "é" * 300])
    again = docs(spark, [(1, periodic), (2, f"own {periodic} end"), (3, periodic)])
    got = {r.doc_id: r.text for r in chunks.drop_repeated_substrings(again).collect()}
    assert got[3] == "" and len(got[2]) < 120 and got[1].startswith("word " * 20)


def test_cuts_of_a_whole_table_are_the_repeats_of_a_plain_search(spark):
    rows = sorted(table(spark.read.parquet(f"{SF}/documents.parquet")))
    draw = random.Random(4)
    long_texts = [t for _, t in rows if t and len(t) > 800]
    planted = []
    for i in range(120):
        source = draw.choice(long_texts)
        n = draw.choice([100, 140, 200, 300, 600])
        at = draw.randrange(len(source) - n)
        planted.append((10**6 + i, f"own start {i} of it {source[at : at + n]} own end {i}"))
    rows += planted
    got = {r.doc_id: r for r in chunks.drop_repeated_substrings(docs(spark, rows)).collect()}
    seen: set[bytes] = set()
    repeated = missed = 0
    for i, text in rows:
        data = (text or "").encode()
        is_cut, earlier, apart, own = bytearray(len(data)), bytearray(len(data)), bytearray(len(data)), {}
        for s in got[i].cut_spans:
            is_cut[s.start : s.end] = b"\1" * (s.end - s.start)
        for a in range(len(data) - 99):
            gram = data[a : a + 100]
            if gram in seen or gram in own:
                earlier[a : a + 100] = b"\1" * 100
            if gram in seen or own.setdefault(gram, a) + 100 <= a:
                apart[a : a + 100] = b"\1" * 100
        assert all(e or not c for c, e in zip(is_cut, earlier))
        for m in re.finditer(b"\1{200,}", bytes(apart)):
            repeated += m.end() - m.start()
            missed += is_cut[m.start() : m.end()].count(0)
        seen |= own.keys()
    assert repeated > 10_000 and missed <= 0.01 * repeated


def test_fingerprints_of_short_and_long_texts_have_one_scale():
    like = lambda a, b: fingerprint.likeness(fingerprint.digest(a.encode()), fingerprint.digest(b.encode()))
    assert like("ab", "zq") < 0.1 and like("the cat sat on a mat", "quarterly tax 9931") < 0.2 and like("", "a") == 0.0
    assert like("", "") == like("ab", "ab") == like("a\0", "a\0") == 1.0
    rng = random.Random(4)
    for n in (10, 40, 200, 1_000, 5_000, 20_000):
        a, b = ("".join(rng.choices("abcdefghijklmnopqrstuvwxyz ", k=n)) for _ in range(2))
        # Counts of very long texts approach the shares of triplets that the source has: 0.34 as measured.
        assert like(a, b) < (0.25 if n <= 5_000 else 0.4) and like(a, fingerprint.edited(a, b)) > like(a, b) + 0.2


def test_warc_agrees_with_sql(spark):
    columns, rows = spark_rows(QUERIES["op1_warc"](spark, SF))
    assert (columns, rows) == duck_rows(duck(SF), ORACLE["op1_warc"])


def test_warc_keeps_revisits_without_their_response(spark):
    names = "record_type string, record_id string, refers_to string, payload binary"
    rows = [("response", "<urn:page:1>", None, b"abc"), ("revisit", "<urn:page:2>", "<urn:page:1>", b""),
            ("revisit", "<urn:page:3>", "<urn:page:9>", b""), ("revisit", "<urn:page:3>", "<urn:page:9>", b""),
            ("revisit", "<urn:page:4>", None, b"")]
    got = warc.pages_of(spark.createDataFrame(rows, names)).collect()
    assert sorted((r.page_id, r.payload_bytes, r.record_type) for r in got if r.payload_bytes) == [(1, 3, "response"), (2, 3, "revisit")]
    lost = [(r.page_id, r.payload_digest, r.refers_to) for r in got if r.payload_bytes is None]
    assert sorted(lost) == [(3, None, 9), (3, None, 9), (4, None, None)]


def test_warc_rejects_magic_in_payloads(spark, tmp_path):
    inner = "WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:99>\r\nContent-Length: 5\r\n\r\ninner\r\n\r\n"
    payloads = ["", None, "WARC/1.0\r\n", inner * 30, "x" * 300 + "WARC/1.0\r\n\r\n\r\n", "\r\n\r\n" + "WARC/1.0\r\n" * 50 + "é" * 400, "y" * 2000, "y" * 2000]
    pages = spark.createDataFrame([(i, None, p) for i, p in enumerate(payloads)], "page_id long, url string, html string")
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
        warc.write_archives(pages.repartition(2), str(tmp_path / "a"))
        got = {r.record_id: (r.record_type, bytes(r.payload).decode()) for r in warc.read_archives(spark, str(tmp_path / "a")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = {f"<urn:page:{i}>": ("response", p or "") for i, p in enumerate(payloads)}
    expected["<urn:page:6>"] = ("revisit", "")
    assert got == expected
    warc.write_archives(pages.limit(0), str(tmp_path / "b"))
    assert warc.read_archives(spark, str(tmp_path / "b")).count() == 0


def test_warc_keeps_records_with_long_urls_and_what_follows(spark, tmp_path):
    rows = [(i, f"data:,{str(i) * 400_000}" if i % 2 else f"http://a/{i}", f"page {i}") for i in range(6)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    warc.write_archives(pages.coalesce(1), str(tmp_path / "a"))
    got = {(r.record_id, r.target_uri, bytes(r.payload).decode()) for r in warc.read_archives(spark, str(tmp_path / "a")).collect()}
    assert got == {(f"<urn:page:{i}>", url, html) for i, url, html in rows}


def test_visible_text_is_that_of_a_pattern_and_takes_one_pass():
    hidden = re.compile(rb"<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>", re.I | re.S)
    draw = random.Random(1)
    parts = [b"<", b">", b"<!--", b"-->", b"<script", b"</script>", b"</SCRIPT >", b"<style ", b"</style>", b"a", b" ", b"-", b"<b>"]
    for _ in range(20_000):
        page = b"".join(draw.choices(parts, k=draw.randrange(15)))
        assert langid.visible(page) == hidden.sub(b" ", page)
    for page in (b"<!-- >" * 800_000, b"<script>" * 600_000, b"<style> <!-- >" * 350_000, b"<" * 5_000_000, b"<!--" * 1_250_000):
        began = time.process_time()
        langid.visible(page)
        assert time.process_time() - began < 5


def test_languages(spark, empty):
    got = QUERIES["op2_langid"](spark, SF)
    assert got.count() == 50 and got.where("lang = declared").count() >= 48
    odd = spark.createDataFrame([(1, None, None), (2, "nonsense", ""), (None, "http://a.de/", "<html lang=de>")], "page_id long, url string, html string")
    known = spark.read.parquet(f"{SF}/documents.parquet")
    assert langid.identify(odd, known).count() == 3
    assert {r.lang for r in langid.identify(odd, empty).collect()} == {"und"}
    assert langid.identify(odd.limit(0), known).count() == 0


def test_licences(spark, edge, empty):
    known = spark.read.parquet(f"{SF}/documents.parquet")
    model = licences.fit(known)
    assert 0.05 < model.threshold < 0.95
    lines = {"Released under the MIT License.": "MIT", "Licensed under the Apache License, Version 2.0.": "Apache",
             "This work is licensed under the GNU General Public License, version 3.": "GPL", "Licensed under CC BY-NC 4.0.": "CC-BY-NC",
             "// SPDX-License-Identifier: LGPL-2.1-or-later": "LGPL", "Licensed under the Vogon Poetry License.": "unknown",
             "a license to drive a car": None, "nothing of the kind": None}
    got = families(licences.scan(docs(spark, [(i, f"before\n{t}\nafter") for i, t in enumerate(lines)]), model))
    assert got == {i: {f} for i, f in enumerate(lines.values()) if f}
    plan = licences.scan(known, model)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
    assert licences.scan(edge, model).count() == licences.scan(empty, model).count() == 0


def families(found):
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, set()).add(r.family)
    return got


def test_licence_notices_wrapped_as_in_source_files(spark):
    """Whole notices at 60 to 80 columns, bare and in comments, within prose that names licences in passing."""
    known = spark.read.parquet(f"{SF}/documents.parquet")
    model = licences.fit(known)
    prose = known.where("n_chars > 2000").orderBy("doc_id").first().text
    rows, wanted = [], []
    for family in ("GPL", "LGPL", "AGPL", "MIT", "BSD", "Apache", "MPL"):
        gnu = [p.format(licences.GNU[family]) for p in licences.GNU_NOTICE] if family in licences.GNU else []
        for width in (60, 70, 80):
            for mark in ("", "# ", " * "):
                parts = ["\n".join(mark + x for x in textwrap.wrap(p, width)) for p in gnu or licences.NOTICES[family]]
                rows.append((len(rows), f"{prose}\n\n" + f"\n{mark.rstrip()}\n".join(["Copyright (c) 2020 Jo Doe", *parts]) + f"\r\n\r\n{prose}"))
                wanted.append((family, len(parts)))
    got = licences.scan(docs(spark, rows), model).collect()
    for i, (family, n) in enumerate(wanted):
        assert [r.family for r in got if r.doc_id == i] == [family] * n
    other = ["The driving licence is issued under the terms of the road act, and you should have received a copy of it by post. "
             "See the office for more details, or write to the holder of the public register if you can.",
             "Permission was hereby refused to all who asked for the use of the copy, without limitation of any kind."]
    assert all(f == {"unknown"} for f in families(licences.scan(docs(spark, enumerate(other)), model)).values())


def test_licences_agree_with_a_plain_scan(spark):
    """Passages and likenesses of every document against loops over its words; null ids, repeated rows, one long line."""
    known = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    notice = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software"
    odd = [(None, "Released under the MIT License."), (7, notice), (7, notice), (8, "word " * 200_000 + notice + " word" * 200_000),
           (9, "\n" * 50_000 + notice + "\n" * 50_000), (10, None), (11, "under the\n \nMIT License")]
    rows = known.unionByName(spark.createDataFrame(odd, "doc_id long, text string")).withColumns(
        {c: F.lit("mine") for c in ("words", "pairs", "grams", "features", "probability", "family", "paragraph")}
    )
    templates = [set(p) for lists in licences.template_pairs().values() for p in lists]
    union = set().union(*templates)
    wanted = []
    for doc, text, *_ in rows.collect():
        cut = re.split(licences.PARAGRAPH_BREAK.replace(r"[^\p{L}\p{N}]", r"[\W_]"), re.sub("\r\n?", "\n", text or ""))
        for no, part in enumerate(cut):
            w = re.findall(r"[^\W_]+", part.lower())
            hits = [i for i in range(len(w) - 1) if f"{w[i]} {w[i + 1]}" in union]
            runs = []
            for h in hits:
                runs.append([h, h]) if not runs or h - runs[-1][1] > licences.GAP else runs[-1].__setitem__(1, h)
            for a, b in runs:
                held = {f"{w[i]} {w[i + 1]}" for i in range(a, b + 1)}
                best = max(len(held & t) / len(t) for t in templates)
                if b > a and best >= licences.LISTED:
                    wanted.append((str(doc), no, a, b - a + 2, round(best, 6)))
    got = [(str(r.doc_id), r.paragraph_no, r.start_word, r.n_words, r.similarity) for r in licences.scan(rows).collect()]
    assert sorted(got) == sorted(wanted) and len(got) > 4


def test_quality_on_held_out_labels(spark, edge, empty):
    sf = "/root/testdata/sf0.01"
    got = QUERIES["op10_quality"](spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out")
    right = got.where("predicted = quality").count()
    assert right >= 0.95 * got.count() and got.count() > 50
    labels = spark.createDataFrame([(5, 1, 0), (None, 0, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.score_documents(edge, labels).collect()
    assert len(rows) == edge.count() and {r.score for r in rows} == {0.5}
    assert quality.score_documents(empty, labels).count() == 0


def test_pipeline_stages(spark, edge):
    source = spark.read.parquet(f"{SF}/documents.parquet")
    one = corpus_pipeline.one_of_each(spark, source, SF)
    comp = linked_components(table(source))
    assert sorted(r.doc_id for r in one.collect()) == sorted(d for d, (_, c) in comp.items() if d == c)
    clean = corpus_pipeline.without_benchmark(spark, source, SF)
    bad = {r.doc_id for r in QUERIES["op7_decontaminate"](spark, SF).collect()}
    assert {r.doc_id for r in clean.collect()} == {r.doc_id for r in source.collect()} - bad
    out = corpus_pipeline.run(spark, SF)
    assert 100 < out.count() < 200 and out.where("not round_trip").count() == 0
    # Working columns of the stages are a table's own columns as well, and come back as they were.
    named = source.withColumns({c: F.lit("mine") for c in ("__key", "__mark", "__x", "__text", "__0")})
    for stage in (corpus_pipeline.good_documents, corpus_pipeline.one_of_each, corpus_pipeline.without_repeats, corpus_pipeline.without_benchmark):
        kept = stage(spark, named, SF)
        assert kept.columns == named.columns
        assert [tuple(r) for r in kept.select("__key", "__mark", "__x", "__text", "__0").distinct().collect()] == [("mine",) * 5]
    shown = source.limit(0).select(*edge.columns[:5])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, shown, SF).count() == 0
        stage(spark, edge.select(*edge.columns[:5]), SF).write.format("noop").mode("overwrite").save()


def test_planted_queries_are_registered():
    assert {re.match(r"op(\d+)_", q)[1] for q in QUERIES} == {str(i) for i in range(1, 14)}
    assert [n for n, _ in corpus_pipeline.STAGES] and F
