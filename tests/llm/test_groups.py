"""Near duplicates and top-k search against plain versions."""

import random

import numpy as np
from pyspark.sql import functions as F

from fixtures import frame, odd_rows, prose
from wayfare.llm import components, mtree, ngramjoin, shingles


def plain_groups(rows, words=5, percent=80):
    sets = []
    for _, t in rows:
        w = (t or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
        w = [x for x in w.translate(str.maketrans({c: " " for c in "\t\n\x0b\x0c\r"})).split(" ") if x]
        sets.append({tuple(w[k : k + words]) for k in range(max(1, len(w) - words + 1))} if w else set())
    parent = list(range(len(rows)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            common = len(sets[a] & sets[b])
            if common and 100 * common >= percent * len(sets[a] | sets[b]):
                parent[top(a)] = top(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[top(k)] = min(i, least.get(top(k), i))
    return sorted((i or -1, len(s), (least.get(top(k)) if s else i) or -1) for k, ((i, _), s) in enumerate(zip(rows, sets)))


def copies():
    """Groups of near copies at all distances around the limit, common passages, exact copies."""
    chance = random.Random(8)
    rows, passage = [], prose(99, 40)
    for group in range(6):
        base = prose(group, chance.choice([4, 8, 30, 120, 300]))
        for _ in range(40):
            own = list(base)
            for _ in range(chance.randrange(0, max(2, len(own) // 25))):
                own[chance.randrange(len(own))] = f"n{chance.randrange(10**6)}"
            if chance.random() < 0.2:
                own = passage + own
            rows.append((len(rows) + 1, " ".join(own)))
    rows += [(len(rows) + 1 + k, "Same  text\tHERE again and again") for k in range(50)]
    rows += [(1000 + k, " ".join(prose(500 + k, 60) + passage)) for k in range(30)]
    return rows


def test_groups_are_those_of_all_pairs(spark, monkeypatch):
    monkeypatch.setattr(ngramjoin, "BLOCK", 7)  # many blocks to a shingle
    rows = copies() + [(None if i is None else i + 5000, t) for i, t in odd_rows()]
    found = ngramjoin.near_duplicates(frame(spark, rows).repartition(5)).collect()
    assert sorted((r.doc_id or -1, r.n_shingles, r.component_id or -1) for r in found) == plain_groups(rows)


def test_one_of_each_group_stays(spark):
    rows = copies()[::3] + [(None if i is None else i + 5000, t) for i, t in odd_rows()]
    kept = ngramjoin.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark, []).columns
    stays = [(r.doc_id or -1, r.text or "") for r in kept.collect()]
    heads = {c for _, n, c in plain_groups(rows) if n}
    # Two texts share an id, and each heads a group of its own.
    assert sorted(i for i, t in stays if t.split()) == sorted([*heads, 5004])
    assert sum(not t.split() for _, t in stays) == sum(not (t or "").split() for _, t in rows)


def test_no_documents(spark):
    assert ngramjoin.near_duplicates(frame(spark, [])).collect() == []


def test_shingle_sets_are_those_of_words():
    texts = [b"", b"a b", b"a b c d e", b"A B c d e", b"a b c d e f a b c d e", b" x\ty\n"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    values, firsts = shingles.shingle_sets(data, np.cumsum([0] + [len(t) for t in texts]), 5)
    assert np.diff(firsts).tolist() == [0, 1, 1, 1, 6, 1]
    assert values[firsts[2]] == values[firsts[3]] and values[firsts[2]] in values[firsts[4] : firsts[5]]


def test_components_of_chains_and_stars(spark):
    links = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 140)] + [(200, 201), (201, 200), (7, 7)]
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    assert {r.node: r.label for r in found} == {
        **{k: 0 for k in range(41)}, **{k: 100 for k in range(100, 140)}, 200: 200, 201: 200
    }
    assert components.components(spark.createDataFrame([], "a long, b long")).collect() == []


def plain_best(rows, asked, k):
    whole = [(i, np.floor(1024 * np.array(v, float)).astype(int)) for i, v in rows
             if i is not None and v is not None and None not in v and np.isfinite(v).all()]
    out = []
    for i, v in asked:
        if i is None or v is None or None in v or not np.isfinite(v).all():
            continue
        query = np.floor(1024 * np.array(v, float)).astype(int)
        others, left = [], False
        for j, own in whole:
            if j == i and not left and (own == query).all():
                left = True
                continue
            others.append((-int(query @ own), j))
        out += [(i, n + 1, j, -s) for n, (s, j) in enumerate(sorted(others)[:k])]
    return sorted(out)


def test_best_rows_are_those_of_all_pairs(spark):
    chance = np.random.default_rng(2)
    centres = chance.normal(size=(5, 6))
    rows = [(k, (centres[k % 5] + 0.2 * chance.normal(size=6)).tolist()) for k in range(700)]
    rows += [(1000 + k, rows[0][1]) for k in range(40)]  # a common vector
    rows += [(3000, rows[3][1]), (3000, rows[3][1]), (3020, [2.2e6] + [0.0] * 5), (3021, [-2.2e6, 2.0] + [0.5] * 4)]  # twins, large ones
    rows += [(2000, None), (2100, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (2200, [float("nan")] * 6), (None, [0.1] * 6), (700, [0.0] * 6)]
    schema = "vec_id long, embedding array<double>, score string, rank int"
    table = spark.createDataFrame([(i, v, "s", 1) for i, v in rows], schema)
    asked = table.filter(F.col("vec_id") % 20 == 0)
    for size in (8, 50, 4096):
        found = mtree.top_k(table, asked, k=7, tree_size=size).collect()
        expected = plain_best(rows, [(i, v) for i, v in rows if i is not None and i % 20 == 0], 7)
        assert sorted(map(tuple, found)) == expected


def test_fewer_candidates_than_asked_for(spark):
    schema = "vec_id long, embedding array<double>"
    table = spark.createDataFrame([(0, [1.0]), (1, [2.0])], schema)
    assert [tuple(r) for r in mtree.top_k(table, table.filter("vec_id = 0")).collect()] == [(0, 1, 1, 1024 * 2048)]
    none = spark.createDataFrame([], schema)
    assert mtree.top_k(none, none).collect() == []


def test_bounds_save_computations():
    chance = np.random.default_rng(3)
    rows = np.floor(1024 * np.vstack([c + 0.01 * chance.normal(size=(200, 3)) for c in chance.normal(size=(20, 3))]))
    largest = float((rows**2).sum(axis=1).max())
    import pandas as pd

    pages = [
        (0, n, p["leaf"], rows[p["rows"]].astype("<i8").tobytes(), p["radii"], p["parents"], p["children"],
         [[int(r)] for r in p["rows"]] if p["leaf"] else [], 0.0)
        for n, p in enumerate(mtree.built(rows, largest))
    ]
    tree = mtree.Tree(pd.DataFrame(pages, columns=[x.split()[0] for x in mtree.PAGES.split(", ")]), 3, largest)
    asked = [17, 40, 999]
    found = tree.search(rows[asked].astype("<i8"), asked, np.full(3, mtree.NO_FLOOR), 5, True)
    for at, answers in zip(asked, found):
        scores = rows @ rows[at]
        scores[at] = -np.inf
        assert [-s for s, _ in answers] == sorted(scores, reverse=True)[:5]
    assert tree.computed < 3 * len(rows) / 2


def test_bitmaps_of_any_width_never_differ_in_more_bits_than_sets_do():
    chance = np.random.default_rng(5)
    pool = shingles.mixed(np.arange(1, 9000, dtype=np.uint64))
    sets = [np.sort(chance.choice(pool, size, replace=False)) for size in (0, 1, 7, 1000, 1024, 1025, 1200, 2500, 7000)]
    sets.append(np.union1d(sets[-1][40:], pool[:3]))
    firsts = np.concatenate([[0], np.cumsum([len(own) for own in sets])])
    maps = ngramjoin.bitmaps(np.concatenate(sets), firsts)
    assert [len(own) * 8 for own in maps] == [1024] * 5 + [2048] * 2 + [4096] + [8192] * 2
    places = [(a, b) for a in range(len(sets)) for b in range(len(sets))]
    differ = ngramjoin.differing([maps[a] for a, _ in places], [maps[b] for _, b in places])
    for (a, b), found in zip(places, differ.tolist()):
        apart = len(np.setxor1d(sets[a], sets[b]))
        assert found <= apart and (found - apart) % 2 == 0
        assert a != b or found == 0
    wide = differ[places.index((7, 8))]
    assert wide > 1000  # two long unlike sets are told apart
    assert (ngramjoin.folded(maps, 64).shape) == (len(sets), 64)


def test_links_between_long_texts_are_found(spark):
    chance = np.random.default_rng(6)
    words = [f"w{k}" for k in range(40000)]
    base = chance.choice(words, 3000).tolist()
    near = base[:1500] + ["new"] + base[1500:2900]
    far = base[:1800] + chance.choice(words, 1200).tolist()
    other = base[:200] + chance.choice(words, 2800).tolist()
    rows = [(k, " ".join(own)) for k, own in enumerate((far, base, other, near, near[5:]))]
    found = {r.doc_id: r.component_id for r in ngramjoin.near_duplicates(frame(spark, rows)).collect()}
    assert found == {0: 0, 1: 1, 2: 2, 3: 1, 4: 1}
