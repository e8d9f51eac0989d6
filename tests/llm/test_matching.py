import hashlib
import random
import re
from collections import defaultdict

import pyarrow as pa
import pytest

from corpusloom.llm import anchors, components, decontaminate, jaccard, substrings, suffixes

from .helpers import empty_docs, odd_docs, of_texts


def shingles(text, size):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < size:
        return {tuple(w)} if w else set()
    return {tuple(w[i : i + size]) for i in range(len(w) - size + 1)}


def brute_components(docs, size, num, den):
    sets = {d: shingles(t, size) for d, t in docs}
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and sets[a] and sets[b]:
                shared = len(sets[a] & sets[b])
                if den * shared >= num * (len(sets[a]) + len(sets[b]) - shared):
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
    return {d: (len(s), find(d)) for d, s in sets.items()}


def near_texts(rng, groups, spread):
    out = []
    for g in range(groups):
        base = [f"w{rng.randrange(40)}" for _ in range(rng.randrange(1, 60))]
        for _ in range(rng.randrange(1, spread)):
            t = list(base)
            for _ in range(rng.randrange(4)):
                t[rng.randrange(len(t))] = f"V{g}{rng.randrange(9)}"
            out.append(" ".join(t))
    return out


@pytest.mark.parametrize(("size", "num", "den"), [(3, 9, 10), (5, 4, 5), (2, 1, 2)])
@pytest.mark.parametrize("longest", [64, 2])
def test_components_equal_brute_force(spark, monkeypatch, size, num, den, longest):
    monkeypatch.setattr(jaccard, "LIST", longest)
    monkeypatch.setattr(jaccard, "HUBS", 1 if longest == 2 else 4)
    texts = [*near_texts(random.Random(size), 12, 12), "", None, "One two", "one two", " \t"]
    docs = of_texts(spark, texts)
    rows = jaccard.NgramJoin(docs, size, num, den).members().collect()
    expected = brute_components([(r.doc_id, r.text) for r in docs.collect()], size, num, den)
    assert {r.doc_id: (r.n, r.component_id) for r in rows} == expected


def test_one_of_each_group_stays(spark):
    texts = near_texts(random.Random(5), 8, 6)
    docs = of_texts(spark, [*texts, "", None])
    expected = {root for _, root in brute_components([(r.doc_id, r.text) for r in docs.collect()], 5, 4, 5).values()}
    assert {r.doc_id for r in jaccard.without_near_copies(docs).collect()} == expected


def test_near_copies_of_odd_rows(spark):
    docs = odd_docs(spark)
    kept = jaccard.without_near_copies(docs)
    assert kept.columns == docs.columns
    # NULL, two empty, blank; one of the plain words; the other text of id 2; long; one long word; no id
    rows = sorted((r.doc_id is not None, r.doc_id or 0, len(r.text or "")) for r in kept.collect())
    long_text = max(r[2] for r in rows)
    assert rows == [(False, 0, 0), (False, 0, 30), (True, 1, 0), (True, 1, 0), (True, 2, 35), (True, 2, 38), (True, 4, long_text), (True, 5, 4), (True, 6, 300_000)]
    assert jaccard.without_near_copies(empty_docs(spark)).count() == 0
    assert jaccard.NgramJoin(docs).members().count() == 11


def test_components_of_chains(spark):
    links = [(i, i + 1) for i in range(0, 40)] + [(100, 101), (None, 7), (50, 50)]
    rows = components.components(spark.createDataFrame(links, "u long, v long")).collect()
    assert {r.u: r.root for r in rows} == {**{i: 0 for i in range(41)}, 100: 100, 101: 100}


def test_leaks_within_the_edit_bound(spark):
    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcdefgh") for _ in range(6))
    items = [[word() for _ in range(rng.randrange(6, 50))] for _ in range(25)]
    docs, planted = [], set()
    for i in range(120):
        text = [word() for _ in range(rng.randrange(5, 80))]
        if i % 2:
            m = rng.randrange(len(items))
            t = list(items[m])
            for _ in range(rng.randrange(decontaminate.allowed(len(t)) + 1)):
                kind, at = rng.randrange(3), rng.randrange(len(t))
                if kind == 0:
                    t[at] = word()
                elif kind == 1:
                    t.insert(at, word())
                else:
                    del t[at]
            at = rng.randrange(len(text))
            text[at:at] = [", ".join(t[:3]).upper() + ";", *t[3:]]
            planted.add((i, m))
        docs.append(" ".join(text))
    bench = spark.createDataFrame([(i, " ".join(t)) for i, t in enumerate(items)], "item_id long, text string")
    table = of_texts(spark, docs)
    found = {(r.doc_id, r.item_id) for r in decontaminate.leaks(table, bench).collect()}
    assert found <= planted and len(found) >= 0.95 * len(planted)
    left = {r.doc_id for r in decontaminate.without_leaks(table, bench).collect()}
    assert left == set(range(120)) - {d for d, _ in found}


def test_alignment():
    import numpy as np

    rng = random.Random(7)
    for _ in range(200):
        a = [rng.randrange(3) for _ in range(rng.randrange(1, 7))]
        b = [rng.randrange(3) for _ in range(rng.randrange(9))]

        def distance(x, y):
            row = list(range(len(y) + 1))
            for i, c in enumerate(x, 1):
                new = [i]
                for j, d in enumerate(y, 1):
                    new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (c != d)))
                row = new
            return row[-1]

        best = min(distance(a, b[i:j]) for i in range(len(b) + 1) for j in range(i, len(b) + 1))
        got, start, end = decontaminate.aligned(np.array(a, np.uint64), np.array(b, np.uint64))
        assert got == best == distance(a, b[start:end])


def test_leaks_of_odd_rows(spark):
    bench = spark.createDataFrame([(1, "a few plain words in one short text"), (2, None), (None, "x"), (3, ""), (4, "the of")], "item_id long, text string")
    docs = odd_docs(spark)
    assert {(r.doc_id, r.item_id) for r in decontaminate.leaks(docs, bench).collect()} == {(2, 1), (3, 1)}
    left = decontaminate.without_leaks(docs, bench)
    assert left.columns == docs.columns and left.count() == 8
    assert decontaminate.leaks(empty_docs(spark), bench).count() == 0
    assert decontaminate.leaks(docs, bench.where("false")).count() == 0
    assert decontaminate.without_leaks(docs, bench.where("false")).count() == 11


def test_short_items_and_items_without_id(spark):
    bench = spark.createDataFrame(
        [(1, "Paris"), (2, "red, green blue"), (3, "four words of it"), (None, "seven words that no one has named yet")], "item_id long, text string"
    )
    docs = of_texts(spark, ["in paris today", "comparison", "red green", "a RED green (blue)", "green blue four words of", "it", "so seven words that no one has named yet"])
    found = {(r.doc_id, r.item_id, r.first_word, r.end_word, r.distance) for r in decontaminate.leaks(docs, bench).collect()}
    assert found == {(0, 1, 1, 2, 0), (3, 2, 1, 4, 0)}
    assert {r.doc_id for r in decontaminate.without_leaks(docs, bench).collect()} == {1, 2, 4, 5}


def test_long_items_among_short_ones_are_found():
    """Items with the most edits: every length has the target recall, whatever else is in the block."""
    import numpy as np

    rng = np.random.default_rng(4)
    items = [rng.integers(1, 1 << 62, n).astype(np.uint64) for n in [12] * 400 + [100, 150, 256] * 8]
    index = decontaminate.Index.of(list(range(len(items))), items)
    assert index.tables[12] > 0 and index.tables[256] == 0
    found = total = 0
    for m in range(400, len(items)):
        words = items[m].tolist()
        for _ in range(decontaminate.allowed(len(words))):
            at, kind = int(rng.integers(len(words))), int(rng.integers(3))
            if kind == 0:
                words[at] = int(rng.integers(1 << 62))
            elif kind == 1:
                words.insert(at, int(rng.integers(1 << 62)))
            else:
                del words[at]
        text = np.array([*rng.integers(1, 1 << 62, 50), *words, *rng.integers(1, 1 << 62, 50)]).astype(np.uint64)
        total += 1
        found += any(r[1] == m for r in index.search(text, np.array([0, len(text)])))
    assert found == total


def test_suffix_arrays():
    rng = random.Random(8)
    for _ in range(2000):
        s = [rng.randint(1, rng.randint(1, 4)) for _ in range(rng.randrange(40))] + [0]
        array = suffixes.suffix_array(s)
        assert array == sorted(range(len(s)), key=lambda i: s[i:])
        shared = suffixes.common_prefixes(s, array)
        for k in range(1, len(s)):
            a, b = s[array[k - 1] :], s[array[k] :]
            n = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))
            assert shared[k] == n
    assert suffixes.suffix_array([]) == []


def brute_removal(docs, length):
    seen, out = set(), {}
    for d, t in sorted(docs):
        b = (t or "").encode()
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = [True] * length
            seen.add(w)
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out[d] = (len(b), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("group", [20_000, 1])
def test_removal_equals_brute_force(spark, monkeypatch, group):
    rng = random.Random(9)
    pool = ["".join(rng.choice("abcdé ") for _ in range(rng.randrange(20, 400))) for _ in range(15)]
    texts = []
    for _ in range(80):
        pieces = [rng.choice(pool) if rng.random() < 0.6 else "".join(rng.choice("xyz ") for _ in range(rng.randrange(50))) for _ in range(rng.randrange(5))]
        if rng.random() < 0.3 and pieces:
            p = pieces[0]
            pieces[0] = p[rng.randrange(len(p) or 1) :]
        texts.append("".join(pieces))
    texts += ["a" * 350, "ab" * 300, texts[3], "", None, "b" + "a" * 99]
    docs = of_texts(spark, texts)
    monkeypatch.setattr(substrings, "GROUP", group)
    if group == 1:
        lists = substrings.removals
        monkeypatch.setattr(substrings, "removals", lambda d, n: lists(d, n, 1, floor=2, look=1))
    rows = substrings.deduplicated(docs).collect()
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in rows}
    assert got == brute_removal([(r.doc_id, r.text) for r in docs.collect()], 100)


def test_long_rows_choose_the_same_places(monkeypatch):
    rng = random.Random(10)
    text = "".join(rng.choice("abcdef ") for _ in range(9000))
    batch = pa.record_batch([pa.array([1]), pa.array([text]), pa.array([0])], names=["doc_id", "text", "tie"])
    look = substrings._occurrences(100)
    rows = lambda: {(r["h"], r["place"], r["around"]) for b in look([batch]) for r in b.to_pylist()}
    whole = rows()
    monkeypatch.setattr(substrings, "PART", 1000)
    assert rows() == whole and len(whole) > 200
    assert anchors.GRAM < 100


def test_removal_of_odd_rows(spark):
    rows = substrings.deduplicated(odd_docs(spark)).collect()
    by = defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r.n_removed)
    assert len(rows) == 11 and by[6] == [300_000 - 1] and by[1] == [0, 0] and by[2] == [0, 0, 0]
    assert substrings.deduplicated(empty_docs(spark)).count() == 0


def test_documents_of_one_id_are_told_apart_exactly(spark):
    rng = random.Random(21)
    shared = "".join(rng.choice("abcdefgh") for _ in range(150))
    texts = [(None, shared + str(i)) for i in range(5000)] + [(None, shared + "7"), (1, "x" + shared), (2, "a plain one"), (2, "a plain one")]
    docs = spark.createDataFrame(texts, "doc_id long, text string")
    ties = substrings._ties(docs).where("doc_id IS NULL").select("text", "tie").distinct().collect()
    assert len(ties) == 5000 and sorted(r.tie for r in ties) == list(range(5000))
    assert {r.tie for r in substrings._ties(docs).where("doc_id = 2").collect()} == {0}
    order = {r.text: r.tie for r in ties}
    got = {(r.doc_id, r.n_bytes, r.n_removed) for r in substrings.deduplicated(docs).collect()}
    # ids that are NULL come first; of them the text with tie 0 keeps all
    first = next(t for t, k in order.items() if k == 0)
    assert (None, len(first.encode()), 0) in got and (1, 151, 150) in got


def test_hot_grams_are_drawn_from_pieces(spark, monkeypatch):
    """Pieces are cut at bytes, also inside a character, and put together give every text."""
    texts = ["\u00f6\u65e5" * 50, "", None, "x" * 64, "y" * 65]
    docs = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)], "doc_id long, text string, tie long")
    monkeypatch.setattr(substrings, "PIECE", 64)
    rows = substrings._pieces(docs, 1).collect()
    for i, text in enumerate(texts):
        pieces = [r.text for r in sorted((r for r in rows if r.doc_id == i), key=lambda r: r.tie)]
        assert b"".join(pieces) == (text or "").encode()
        assert all(len(p) == 64 for p in pieces[:-1])
    some = substrings._pieces(docs, 3).collect()
    assert 0 < len(some) < len(rows)


@pytest.mark.parametrize("floor", [2, 20_000])
def test_removal_writes_a_table_only_for_what_is_costly(spark, monkeypatch, floor):
    """A table takes a file from each task: the marked occurrences are written, and hot grams' first ones."""
    kept, write = [], substrings.written
    monkeypatch.setattr(substrings, "written", lambda df: kept.append(df.columns) or write(df))
    letters = "".join(random.Random(3).choices("abcdefgh", k=700))
    texts = [letters[k : k + 150] for k in (0, 0, 3, 400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = substrings.removals(docs, floor=floor, look=1).collect()
    assert {r.id_ for r in rows} == {1, 2}
    assert len(kept) == (2 if floor == 2 else 1)
