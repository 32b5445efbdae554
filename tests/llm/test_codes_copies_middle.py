"""Vector codes, MinHash near duplicates and fill-in-middle against brute force and SQL, and on edge rows."""

import hashlib
import math
import random
import re
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from compare import duck, duck_rows, spark_rows
from ledgerlens.llm import fill_middle, near_copies, vector_codes
from ledgerlens.llm.queries import ORACLE, QUERIES
from ledgerlens.scratch import durable

SF = "/root/testdata/sf0.001"
LOWER = {i: i + 32 for i in range(65, 91)}
DOC = "doc_id long, text string, lang string, n long, form string, output string, kept boolean, component_id string"


def docs(spark, texts):
    return spark.createDataFrame([(i, t, None, 9, "f", "o", None, "c") for i, t in texts], DOC)


@pytest.mark.parametrize("name", ["op11_vector_codes", "op12_near_copies", "op13_fill_middle"])
def test_agrees_with_sql(spark, name):
    assert spark_rows(QUERIES[name](spark, SF)) == duck_rows(duck(SF), ORACLE[name])


# ---- vector codes


@settings(max_examples=150, deadline=None)
@given(st.integers(1, 6), st.integers(1, 20), st.integers(0, 2**32 - 1), st.sampled_from([1, 3, 4000, 1 << 26]))
def test_equal_average_search_finds_the_nearest_entry(d, k, seed, spread):
    draw = np.random.default_rng(seed)
    vectors = draw.integers(-spread, spread + 1, (40, d))
    book = draw.integers(-spread, spread + 1, (k, d))
    book[k // 2] = book[0]  # equal entries: the lower one
    entry, distance = vector_codes.nearest(vectors, book)
    every = ((vectors[:, None, :] - book[None]) ** 2).sum(axis=2)
    assert (entry == every.argmin(axis=1)).all() and (distance == every.min(axis=1)).all()


def plain_codes(rows, parts, entries, rounds):
    """Lists of whole numbers only: (codes, errors, books) of rows (id, vector)."""
    rows = [(i, [math.floor(4096 * x) for x in v]) for i, v in rows]
    cut = lambda v: [v[p * len(v) // parts : (p + 1) * len(v) // parts] for p in range(parts)]
    first = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    books = [[cut(v)[p] for _, v in first] for p in range(parts)]
    gap = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    best = lambda part, book: min((gap(part, b), e) for e, b in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            held = defaultdict(list)
            for _, v in rows:
                held[best(cut(v)[p], books[p])[1]].append(cut(v)[p])
            books[p] = [
                [sum(c) // len(held[e]) for c in zip(*held[e])] if e in held else b for e, b in enumerate(books[p])
            ]
    found = [[best(cut(v)[p], books[p]) for p in range(parts)] for _, v in rows]
    return [[e for _, e in f] for f in found], [sum(d for d, _ in f) for f in found], books


VEC = "vec_id long, embedding array<float>, label int, error string, entries string, whole string"


def test_vector_codes_of_odd_rows_are_those_of_plain_lists(spark):
    draw = random.Random(11)
    rows = [(i, [draw.choice([-1.5, -0.25, 0.0, 0.1, 2.0, draw.random()]) for _ in range(12)]) for i in range(90)]
    rows += [(3, rows[3][1]), (4, [7.0] * 12), (None, rows[5][1]), (None, [0.0] * 12)]
    label = lambda k: None if k % 5 == 0 else k % 3
    odd = [(500, None, 1), (501, [math.nan] * 12, 1), (502, [0.5] * 11 + [math.inf], 1), (-9, [None] + [0.5] * 11, 2)]
    given_ = [(i, v, label(k), "e", "n", "w") for k, (i, v) in enumerate(rows)] + [(*r, "e", "n", "w") for r in odd]
    rows = [(i, [float(np.float32(x)) for x in v]) for i, v in rows]
    table = spark.createDataFrame(given_, VEC).repartition(5)
    codes, books = vector_codes.compress(table, parts=4, entries=5, rounds=3)
    expected, errors, plain = plain_codes(rows, 4, 5, 3)
    assert books.entries.tolist() == plain
    by_label = defaultdict(int)
    for k, e in enumerate(errors):
        by_label[label(k)] += e
    found = sorted((r.vec_id is None, r.vec_id or 0, r.label is None, r.label or 0, list(r.entries), r.error, r.label_error) for r in codes.collect())
    assert found == sorted(
        (i is None, i or 0, label(k) is None, label(k) or 0, c, e, by_label[label(k)])
        for k, ((i, _), c, e) in enumerate(zip(rows, expected, errors))
    )
    shown = vector_codes.decode(codes, books).where("vec_id = 7").first()
    assert shown.decoded == [x / 4096 for p, e in enumerate(shown.entries) for x in plain[p][e]]


def test_vector_codes_of_few_or_no_rows(spark):
    none = spark.createDataFrame([], VEC)
    assert vector_codes.compress(none)[0].count() == 0
    only_odd = spark.createDataFrame([(1, None, 1, "", "", ""), (2, [math.nan] * 8, 1, "", "", "")], VEC)
    assert vector_codes.compress(only_odd)[0].count() == 0
    two = spark.createDataFrame([(1, [1.0] * 8, 1, "", "", ""), (2, [1e30] * 8, None, "", "", "")], VEC)
    got = {r.vec_id: r for r in vector_codes.compress(two)[0].collect()}
    assert list(got[1].entries) == [0] * 8 and list(got[2].entries) == [1] * 8 and got[2].error == 0
    ragged = spark.createDataFrame([(1, [1.0] * 8, 1, "", "", ""), (2, [1.0] * 16, 1, "", "", "")], VEC)
    with pytest.raises(ValueError, match="one length"):
        vector_codes.compress(ragged)


# ---- near duplicates


def linked_components(rows, words=4, percent=80):
    sets = []
    for d, t in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(LOWER))
        k = min(words, len(w))
        sets.append((d, {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()))
    low = {d: d for d, _ in sets}

    def find(x):
        while low[x] != x:
            x = low[x]
        return x

    for (a, s), (b, t) in combinations(sets, 2):
        c = len(s & t)
        if c and 100 * c >= percent * (len(s) + len(t) - c):
            x, y = find(a), find(b)
            low[max(x, y)] = min(x, y)
    return {d: (len(s), find(d), find(d) == d) for d, s in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in near_copies.near_duplicates(df).collect()}


def test_signatures_within_the_guaranteed_distance_share_a_key():
    draw = np.random.default_rng(12)
    a = draw.integers(0, 1 << 16, (200, near_copies.SYMBOLS)).astype(near_copies.SYMBOL)
    b = a.copy()
    for row in b:
        at = draw.choice(near_copies.SYMBOLS, near_copies.guaranteed_distance(), replace=False)
        row[at] ^= 1
    worst = a[0].copy()  # errors spread as evenly as they can be: one in all chunks, a second in all but one
    worst[:: near_copies.CHUNK_SYMBOLS] ^= 1
    worst[1 + near_copies.CHUNK_SYMBOLS :: near_copies.CHUNK_SYMBOLS] ^= 1
    b[0] = worst
    assert (a[0] != worst).sum() == near_copies.guaranteed_distance()
    shared = [np.intersect1d(x, y).size for x, y in zip(near_copies.keys_of(a), near_copies.keys_of(b))]
    assert min(shared) >= 1
    assert np.intersect1d(near_copies.keys_of(a)[0], near_copies.keys_of(a)[1]).size == 0


def test_every_key_but_those_of_an_error_stays():
    a = np.arange(near_copies.SYMBOLS).astype(near_copies.SYMBOL)[None]
    b = a.copy()
    b[0, 0] ^= 1
    kept = np.intersect1d(near_copies.keys_of(a), near_copies.keys_of(b)).size
    # In the chunk with the error, the choice that leaves the differing symbol out.
    assert kept == near_copies.KEYS - near_copies.CHUNK_SYMBOLS + 1


def edited(words, draw, share):
    return [f"new{draw.random()}" if draw.random() < share else w for w in words]


def test_components_of_stars_chains_and_boilerplate_are_those_of_all_pairs(spark):
    draw = random.Random(12)
    prose = lambda n: [f"w{draw.randrange(400)}" for _ in range(n)]
    texts = []
    for share in (0.01, 0.03, 0.05):  # copies of an original: hardly linked with one another at the larger shares
        original = prose(130)
        texts += [original, *(edited(original, draw, share) for _ in range(40))]
    line = prose(60)
    texts += [[*line, *prose(25)] for _ in range(60)]  # much in common, but too little
    text = prose(120)
    for _ in range(30):
        text = [*text]
        text[draw.randrange(120)] = f"step{draw.random()}"
        texts.append(text)
    texts += [prose(draw.randrange(1, 9)) for _ in range(20)] + [text] * 5
    draw.shuffle(texts)
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert found(docs(spark, rows).repartition(6)) == linked_components(rows)


@pytest.mark.parametrize("bound", [0, 1 << 60])
def test_open_pairs_and_rounds_lead_to_the_same_components(spark, monkeypatch, bound):
    """With 0, rounds go on until one finds next to nothing; with a large bound there is one."""
    monkeypatch.setattr(near_copies, "OPEN_PER_ROW", bound)
    monkeypatch.setattr(near_copies, "LINKED_SHARE", 0 if not bound else 0.05)
    draw = random.Random(5)
    original = [f"w{i}" for i in range(90)]
    rows = [(i, " ".join(edited(original, draw, 0.025))) for i in range(70)]
    assert found(docs(spark, rows)) == linked_components(rows)


def test_similarity_of_exactly_80_percent_links(spark):
    # 9 shingles each, 8 in common: 8 of 10; one more word apart: 12 of 16.
    a = [f"a{i}" for i in range(12)]
    rows = [(1, " ".join(a)), (2, " ".join([*a[:-1], "z"])), (3, " ".join([*(f"b{i}" for i in range(17))])),
            (4, " ".join([*(f"b{i}" for i in range(15)), "y", "z"]))]
    assert found(docs(spark, rows)) == linked_components(rows)
    assert found(docs(spark, rows))[2][1:] == (1, False) and found(docs(spark, rows))[4][1:] == (4, True)


def test_near_copies_edges(spark):
    long = " ".join(f"w{i % 977}q{i}" for i in range(60_000))
    rows = [(5, long), (6, long.upper()), (0, ""), (1, None), (2, " \n"), (3, "one two"), (4, "ONE\ttwo"), (7, "three"), (7, "three")]
    rows += [(None, "without id a few words"), (None, "without id a few words"), (None, None), (8, "é x y z"), (9, "É x y z")]
    got = near_copies.near_duplicates(docs(spark, rows)).collect()
    assert len(got) == len(rows)
    seen = {(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got}
    assert seen == {
        (5, 59997, 5, True), (6, 59997, 5, False), (0, 0, 0, True), (1, 0, 1, True), (2, 0, 2, True), (3, 1, 3, True),
        (4, 1, 3, False), (7, 1, 7, True), (None, 2, None, True), (None, 0, None, True), (8, 1, 8, True), (9, 1, 9, True),
    }
    assert near_copies.near_duplicates(docs(spark, [])).count() == 0


def test_a_hot_group_forms_few_pairs(spark, monkeypatch):
    """An original and 2,000 copies that are hardly linked with one another: some pairs a member, not some per pair."""
    draw = random.Random(3)
    original = [f"w{i}" for i in range(100)]
    rows = [(0, " ".join(original)), *((i, " ".join(edited(original, draw, 0.02))) for i in range(1, 2000))]
    formed, confirm = [], near_copies.confirmed
    monkeypatch.setattr(near_copies, "confirmed", lambda pairs, *a: confirm(formed.append(pairs := durable(pairs)) or pairs, *a))
    got = found(docs(spark, rows).repartition(8))
    sizes = [p.count() for p in formed]
    in_group = sum(c == 0 for _, c, _ in got.values())
    assert in_group > 1200 and sum(sizes) < 20 * len(rows)
    # Linked or not as the pair with the original says, at least.
    w = set(zip(*[original[i:] for i in range(4)]))
    for i, t in rows:
        t = t.split()
        s = set(zip(*[t[j:] for j in range(4)]))
        if 100 * len(s & w) >= 80 * len(s | w):
            assert got[i][1] == 0


# ---- fill in the middle


UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]", re.S)


@settings(max_examples=200, deadline=None)
@given(st.text(st.one_of(st.sampled_from("ab Z<>PSM\n"), st.characters(exclude_categories=["Cs"])), max_size=400))
def test_skip_list_reaches_every_rank(text):
    units = UNIT.findall(text)
    widths = fill_middle.unit_widths(text)
    assert widths.tolist() == [len(u) for u in units]
    lanes = fill_middle.SkipList(widths)
    assert all(int(u.sum()) == len(units) and int(c.sum()) == len(text) for u, c, _ in lanes.lanes)
    for rank in range(len(units) + 1):
        assert lanes.code_points_before(rank) == len("".join(units[:rank]))


def test_skip_list_of_a_long_text_takes_few_steps():
    widths = np.random.default_rng(1).integers(1, 9, 300_000)
    lanes, ends = fill_middle.SkipList(widths), np.concatenate([[0], np.cumsum(widths)])
    assert 6 <= len(lanes.lanes) <= 12 and len(lanes.lanes[-1][0]) <= 4 * fill_middle.TOP_NODES
    for rank in (0, 1, 2, 149_999, 299_999, 300_000, *range(0, 300_000, 1237)):
        assert lanes.code_points_before(rank) == ends[rank]


def plain_middle(doc_id, text):
    text = text or ""
    units = UNIT.findall(text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[i : i + 8], 16) for i in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return len(units), "plain", None, None, text, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 20:
        return len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", text
    return len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", text


def test_fill_middle_agrees_with_plain_lists_and_is_undone(spark):
    odd = ["", None, "a", "<P>", "a <S> b", "<<S<M", "é\U0001f600 x\n\t<P", "P>S>", ">", "<", "x" * 300_000, "1 " * 50_000, "a\r\n\x0b b"]
    rows = [(i, odd[i % len(odd)]) for i in range(40 * len(odd))] + [(None, "no id"), (3, "again"), (3, "again")]
    made = fill_middle.transform(docs(spark, rows).repartition(4)).withColumn("restored", fill_middle.restored())
    got = [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in made.collect()]
    key = lambda r: tuple((x is None, x or 0) for x in r[:1]) + (str(r[5]), r[2])
    assert sorted(got, key=key) == sorted(((i, *plain_middle(i, t)) for i, t in rows), key=key)
    assert {r[2] for r in got} == {"plain", "psm", "spm"}
    assert fill_middle.transform(docs(spark, [])).count() == 0
    kept = fill_middle.transform(docs(spark, rows[:5]), keep=("doc_id", "lang", "kept"))
    assert kept.columns[:3] == ["doc_id", "lang", "kept"] and kept.count() == 5
    with pytest.raises(ValueError, match="both kept and made"):
        fill_middle.transform(docs(spark, []), keep=("form",))


def test_fill_middle_does_not_shuffle(spark):
    plan = fill_middle.transform(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and F
