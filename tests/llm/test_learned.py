"""The trained models: gradients, held-out accuracy, plain Kneser-Ney."""

import math
import random
from collections import Counter, defaultdict

import numpy as np

from fixtures import frame, odd_rows
from wayfare.llm import frames, language, toxicity

FOLDER = "/root/testdata/sf0.01"


def test_slopes_are_those_of_differences():
    weights = {name: value.astype(np.float64) for name, value in language.initial(3).items()}
    letters = np.frombuffer(b"abcdbcda", np.uint8).reshape(2, 4)
    marks, share = np.array([0, 2]), np.array([1.0, 2.0])
    _, slopes = language.loss_and_slopes(weights, letters, marks, share)
    for name, places in (("Ef", (97, 5)), ("Uf", (1, 40)), ("Ub", (2, 3)), ("Bb", (4,)), ("V", (20, 1)), ("C", (2,)), ("Eb", (100, 33))):
        kept = weights[name][places]
        sides = []
        for step in (1e-5, -1e-5):
            weights[name][places] = kept + step
            sides.append(language.loss_and_slopes(weights, letters, marks, share)[0])
        weights[name][places] = kept
        assert math.isclose((sides[0] - sides[1]) / 2e-5, slopes[name][places], rel_tol=1e-4, abs_tol=1e-8), name


def test_languages_of_held_out_documents(spark):
    docs = frames.table(spark, FOLDER, "documents")
    model = language.fit(docs, documents=120, kept=4000)
    found = language.languages(docs, model).join(docs.select("doc_id", "lang"), "doc_id").filter(toxicity.fold() == 2)
    rows = found.collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.95 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    odd = {r.doc_id: r for r in language.languages(frame(spark, odd_rows()), model).collect()}
    assert [odd[k].lang_pred for k in (1, 2, 3, 8)] == ["und"] * 4 and odd[8].score == 0
    assert odd[4].lang_pred in model.languages


def test_no_language_to_learn(spark):
    docs = frame(spark, odd_rows(), lang=None)
    model = language.fit(docs)
    assert {r.lang_pred for r in language.languages(docs, model).collect()} == {"und"}
    assert language.languages(frame(spark, []), model).collect() == []


def plain_evidence(words, sides):
    """Kneser-Ney by dictionaries, for word counts {word: n} of the two sides."""
    order, discount = toxicity.ORDER, toxicity.DISCOUNT
    counts = []
    for side in sides:
        own = Counter()
        for word, n in side.items():
            shown = b" " + word + b" "
            for at in range(1, len(shown)):
                own[shown[max(0, at - order + 1) : at + 1]] += n
        counts.append(own)
    whole = set(counts[0]) | set(counts[1])

    levels = {}
    current = whole
    for _ in range(order):
        level = defaultdict(int)
        for gram in current:
            level[gram[1:]] += 1
        levels[len(levels)] = level
        current = {g for g in level if len(g) > 1}

    def shared(gram, depth=0):
        """Of grams' last byte after the context without the first byte."""
        suffix = gram[1:]
        if not suffix:
            return 1 / 256
        level = levels[depth]
        same = {g: n for g, n in level.items() if g[:-1] == suffix[:-1] and len(g) == len(suffix)}
        total = sum(same.values())
        lower = shared(suffix, depth + 1) if len(suffix) > 1 else 1 / 256
        return max(same.get(suffix, 0) - discount, 0) / total + discount * len(same) / total * lower

    out = []
    for word in words:
        shown, value = b" " + word + b" ", 0.0
        for at in range(1, len(shown)):
            gram = shown[max(0, at - order + 1) : at + 1]
            logs = []
            for own in counts:
                same = {g: n for g, n in own.items() if g[:-1] == gram[:-1]}
                total = sum(same.values())
                left = discount * len(same) / total if total else 1.0
                if gram in whole:
                    logs.append(math.log(max(own.get(gram, 0) - discount, 0) / max(total, 1) + left * shared(gram)))
                else:
                    logs.append(math.log(left))
            value += logs[0] - logs[1]
        out.append(value)
    return out


def test_evidence_is_plain_kneser_ney():
    chance = random.Random(2)
    make = lambda: bytes(chance.choice(b"abc") for _ in range(chance.randrange(1, 10)))
    sides = [Counter(make() for _ in range(60)) for _ in range(2)]
    keys, tables = [], []
    for side, own in enumerate(sides):
        found, owner = toxicity.grams(list(own))
        distinct, back = np.unique(found, return_inverse=True)
        table = np.zeros((2, len(distinct)))
        table[side] = np.bincount(back, np.array(list(own.values()))[owner])
        keys.append(distinct)
        tables.append(table)
    distinct, back = np.unique(np.concatenate(keys), return_inverse=True)
    both = np.concatenate(tables, axis=1)
    model = toxicity.evidence(distinct, np.bincount(back, both[0]), np.bincount(back, both[1]))
    words = list(sides[0])[:10] + list(sides[1])[:10] + [b"zz", b"abz", b"aaaaaaaaaaaaabbbb"]
    assert np.allclose(model.of(words), plain_evidence(words, sides), atol=1e-9)


def test_toxic_documents_are_told_apart(spark):
    chance = random.Random(1)
    rows, marks = [], []
    for k in range(900):
        words = ["".join(chance.choice("abcdefgh") for _ in range(chance.randrange(2, 7))) for _ in range(60)]
        toxic = k % 6 == 0
        for _ in range(3 if toxic else 0):
            words.insert(chance.randrange(60), chance.choice(["vqkident", "zorrgak"]))
        rows.append((k, " ".join(words)))
        marks.append((k, int(toxic)))
    docs = frame(spark, rows)
    labels = spark.createDataFrame(marks + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.labelled_texts(docs, labels))
    found = {r.doc_id: r.predicted for r in toxicity.toxicity(docs, model).collect()}
    held = [k for k in range(900) if toxicity.fold_of(k) == 2]
    assert sum(found[k] == (k % 6 == 0) for k in held) >= 0.97 * len(held)
    odd = toxicity.toxicity(frame(spark, odd_rows()), model).collect()
    assert len(odd) == len(odd_rows()) and all(0 <= r.score <= 1 for r in odd)
    assert toxicity.toxicity(frame(spark, []), model).collect() == []


def test_no_labels(spark):
    docs = frame(spark, odd_rows())
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.fit(toxicity.labelled_texts(docs, labels))
    assert {r.predicted for r in toxicity.toxicity(docs, model).collect()} == {0}


def test_rare_n_grams_count_at_every_size(spark):
    chance = random.Random(5)
    rows, marks = [], []
    for k in range(240):
        words = ["".join(chance.choice("abcdefgh") for _ in range(chance.randrange(2, 7))) for _ in range(20)]
        if k % 6 == 0:  # each toxic document has a word that occurs once
            words[3] = "zq" + "".join(chance.choice("vwxyz") for _ in range(5))
        rows.append((k, " ".join(words)))
        marks.append((k, int(k % 6 == 0)))
    docs = frame(spark, rows + odd_rows())
    labelled = toxicity.labelled_texts(docs, spark.createDataFrame(marks, "doc_id long, toxic int"))
    score = lambda model, d=docs: sorted(
        (-1 if r.doc_id is None else r.doc_id, round(r.score, 9)) for r in toxicity.toxicity(d, model).collect()
    )
    small, large = toxicity.fit(labelled), toxicity.fit(labelled, entries=300)
    assert isinstance(small.evidence, toxicity.Evidence) and isinstance(large.evidence, toxicity.Tables)
    assert large.evidence.grams.count() == len(small.evidence.keys) > 300
    assert score(large) == score(small)
    assert [r.row.doc_id for r in toxicity.toxicity(frame(spark, rows[:1]), large, rows=True).collect()] == [0]
    assert score(large, frame(spark, [])) == []
