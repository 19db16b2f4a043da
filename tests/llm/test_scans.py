"""Decontamination, personal data and secrets against plain versions."""

import base64
import hashlib
import json
import random
import re
import zlib
from functools import partial

import numpy as np
import pytest
from pyspark import RDD

from fixtures import frame, odd_rows, prose
from wayfare.llm import decontaminate, pii, secretscan
from wayfare.llm.spans import digest, in_code_points, listed

ITEMS = "item_id long, text string, doc_id long"


def plain_contamination(docs, items, size):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(lower))
    out = []
    for i, text in docs:
        words, hit, own = split(text), set(), set()
        for item, t in items:
            w = split(t)
            for at in range(max(1, len(w) - size + 1)) if w else ():
                window = w[at : at + size]
                for p in range(len(words) - len(window) + 1):
                    if words[p : p + len(window)] == window:
                        hit |= set(range(p, p + len(window)))
                        own |= {str(item)} if item is not None else set()
        dirty = bool(hit) and 20 * len(hit) >= len(words)
        out.append((i or -1, len(words), len(hit), ",".join(sorted(own)), dirty))
    return sorted(out)


@pytest.mark.parametrize("limit", [4_000_000, 150])
def test_contamination(spark, limit):
    words = prose(1, 60, 30)
    items = [(1, " ".join(words[:30])), (10, "Two, WORDS!"), (2, None), (3, "…"), (None, "no id here"), (1, "two words")]
    docs = odd_rows() + [
        (20, "before " + "; ".join(words[5:25]).upper() + " after"),
        (21, " ".join(prose(2, 400, 30)) + " two words " + "no id here"),
        (22, "é two words, two\nwords"),
        (23, " ".join(words[:12])),
    ]
    frame_of_items = spark.createDataFrame([(i, t, 5) for i, t in items], ITEMS)
    found = decontaminate.contamination(frame(spark, docs), frame_of_items, automaton_bytes=limit)
    rows = found.collect()
    assert sorted(
        (r.doc_id or -1, r.n_words, r.n_hit, ",".join(r["items"]), r.contaminated) for r in rows
    ) == plain_contamination(docs, items, 13)
    text = dict(docs)[22]
    spans = [r.spans for r in rows if r.doc_id == 22][0]
    assert [text[s.start : s.end] for s in spans] == ["two words, two\nwords"]


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], ITEMS)
    assert decontaminate.contamination(frame(spark, []), none).collect() == []
    rows = decontaminate.contamination(frame(spark, [(1, "a b")]), none).collect()
    assert [(r.n_words, r.n_hit, r.contaminated) for r in rows] == [(2, 0, False)]


def luhn(digits):
    numbers = [int(c) for c in digits][::-1]
    return (sum(numbers[::2]) + sum(sum(divmod(2 * c, 10)) for c in numbers[1::2])) % 10 == 0


def plain_personal(text):
    found = [(m.start(), m.end(), 0) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), m.end(), 1))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            found.append((m.start(), m.end(), 2))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            found.append((m.start(), m.end(), 3))
    return sorted(found)


def personal_texts():
    chance = random.Random(9)
    parts = ["a.b@c.de", "x@y", "@", "1.2.3.4", "1.2.3.256.7", "001.2.3.4", "4111 1111 1111 1111", "4111-1111-1111-1112",
             "+1 (988) 555-2485", "+49 30 1234567890123", "+12", "a@b.c@d.e.f", "12345678901234567890", "é", " ", "-", ".", "9"]
    return ["".join(chance.choice(parts) + chance.choice(["", " ", "\n"]) for _ in range(12)) for _ in range(1500)]


def test_base_personal_data():
    for text in personal_texts():
        raw = text.encode()
        assert sorted(in_code_points(raw, pii.base_spans(raw))) == plain_personal(text), text


def test_trees_learn_and_cut():
    chance = np.random.default_rng(1)
    rows = chance.normal(size=(3000, 4))
    marks = (rows[:, 1] > 0.3) & (rows[:, 2] < 0.5)
    trees = pii.boost(rows[:2000], marks[:2000])
    scores = trees.scores(rows[2000:])
    assert ((scores > 0.5) == marks[2000:]).mean() > 0.9
    cut = pii.cut_at(scores, marks[2000:], 0.98)
    assert marks[2000:][scores >= cut].mean() >= 0.98
    assert pii.cut_at(np.array([0.9, 0.8]), np.array([False, False])) == 2.0


def test_personal_data_of_documents(spark):
    texts = personal_texts()
    rows = [(k, t) for k, t in enumerate(texts)] + [(None if i is None else i + 10_000, t) for i, t in odd_rows()]
    docs = frame(spark, rows)
    model = pii.fit(docs)
    assert model.trees is not None
    found = {r.doc_id: r for r in pii.personal_digests(docs, model).collect()}
    for i, t in rows[:1500]:
        assert found[i].base_sha256 == digest(listed(plain_personal(t), pii.KINDS))
        assert set(filter(None, listed(plain_personal(t), pii.KINDS).split(","))) <= set(found[i].spans.split(","))
    shown = {r.doc_id: r.redacted for r in pii.personal_data(docs, model).collect()}
    assert all("@c.de" not in text for text in shown.values())
    empty = pii.fit(frame(spark, []))
    assert empty.trees is None
    assert pii.personal_digests(frame(spark, []), empty).collect() == []


def personal_documents(first, count):
    """(id, text) of prose with personal data in known forms, and digit groups that are none."""
    chance = random.Random(first)
    digits = lambda n: "".join(chance.choice("0123456789") for _ in range(n))
    rows = []
    for k in range(first, first + count):
        words = prose(k, 40, 30)
        host = chance.choice(["mail.example.org", "corp.net", "uni.edu"])
        words[5] = f"contact {chance.choice('abcde')}{digits(2)}.{chance.choice(['kim', 'lee'])}@{host}"
        words[12] = "server " + ".".join(str(chance.randrange(256)) for _ in range(4))
        words[20] = f"phone +{digits(2)} {digits(3)} {digits(3)} {digits(4)}"
        words[27] = f"order {digits(3)}-{digits(5)}"
        words[33] = f"at home {chance.choice(['x', 'y'])} [note] {digits(4)}.{digits(2)}"
        rows.append((k, " ".join(words)))
    return rows


def test_forms_unknown_to_the_rules_are_added(spark):
    model = pii.fit(frame(spark, personal_documents(0, 400)))
    found = {kind: 0 for kind in range(4)}
    for k, text in personal_documents(10_000, 100):
        raw, spans = pii.rewritten(text.encode(), pii.base_spans(text.encode()))
        base, added = pii.find(raw, model)
        assert not {s for s in spans if s[2] != pii.CARD} & set(base)
        for start, end, kind in spans:
            found[kind] += any(a <= start and end <= b for a, b, _ in added)
    assert min(found[pii.EMAIL], found[pii.IP], found[pii.PHONE]) >= 95, found
    plain = " ".join(prose(1, 80, 30)) + " order 123-45678"
    assert pii.find(plain.encode(), model) == ([], [])


def test_all_proposals_are_learned_from(spark):
    crowd = [(k, " ".join(f"a{j % 7}@b.cd" for j in range(2_000))) for k in range(1, 46)]
    docs = frame(spark, crowd + personal_documents(100, 200)).coalesce(1)  # the crowd comes first
    every = pii.cells(docs).groupBy("learn").agg({"n": "sum"}).collect()
    assert dict(every)[True] > 60_000 * 2
    model = pii.fit(docs)
    assert max(model.cuts[kind] for kind in (pii.EMAIL, pii.IP, pii.PHONE)) < 2
    raw, (span,) = pii.rewritten(b"phone +49 301 555 2485 end", [(6, 22, pii.PHONE)])
    assert any(a <= span[0] and span[1] <= b for a, b, _ in pii.find(raw, model)[1])


def test_trees_do_not_depend_on_how_cells_are_spread(spark):
    docs = frame(spark, personal_documents(0, 60) * 2)
    one, many = pii.fit(docs.coalesce(1)), pii.fit(docs.repartition(7))
    assert one.cuts == many.cuts
    for a, b in zip(one.trees.trees, many.trees.trees, strict=True):
        assert all((x == y).all() for x, y in zip(a, b, strict=True))


def test_a_level_of_a_tree_takes_as_many_tasks_as_its_cells_need(spark, monkeypatch):
    # Partitions by a key are dealt over at least 64, as on a cluster with a fixed number of them.
    dealt = RDD.partitionBy
    monkeypatch.setattr(RDD, "partitionBy", lambda self, n=None, *a, **b: dealt(self, max(64, n or 0), *a, **b))
    held = {
        "spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false",
        "spark.sql.files.maxPartitionBytes": "64k", "spark.sql.files.openCostInBytes": "8k",
    }
    before = {key: spark.conf.get(key) for key in held}
    monkeypatch.setattr(pii, "boosted", partial(pii.boosted, rounds=10))  # 30 levels
    tracker = spark.sparkContext.statusTracker()
    try:
        for key, value in held.items():
            spark.conf.set(key, value)
        docs = frame(spark, personal_documents(0, 60))
        spark.sparkContext.setJobGroup("levels", "levels")
        few = pii.fit(docs)
        jobs = [tracker.getJobInfo(job) for job in tracker.getJobIdsForGroup("levels")]
        spark.sparkContext.setJobGroup("others", "others")
        stages = [tracker.getStageInfo(stage) for job in jobs if job for stage in job.stageIds]
        assert sum(stage.numTasks for stage in stages if stage) < 30 + 20 * 64
        # More tasks than the driver takes sums from add them up in a second round.
        monkeypatch.setattr(pii, "TASK_CELLS", 512)
        monkeypatch.setattr(pii, "TOGETHER", 2)
        many = pii.fit(docs)
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)
    assert few.cuts == many.cuts
    for a, b in zip(few.trees.trees, many.trees.trees, strict=True):
        assert all((x == y).all() for x, y in zip(a, b, strict=True))


def test_text_is_sent_once_with_its_row(spark, monkeypatch):
    texts = [*personal_texts()[:40], None, "", "é x@y.de"]
    docs = frame(spark, list(enumerate(texts)) + [(None, "a@b.cd"), (3, None)])
    sent, send = [], type(docs).mapInArrow
    monkeypatch.setattr(type(docs), "mapInArrow", lambda self, *a, **b: sent.append(self.columns) or send(self, *a, **b))
    model = pii.Model(None, (2.0,) * 4)
    whole = pii.personal_data(docs, model, rows=True)
    assert sent == [["doc_id", "row"]]
    assert whole.columns == ["doc_id", "text", "redacted", "spans", "row"]
    assert whole.schema["row"].dataType == docs.schema
    rows = sorted(whole.collect(), key=lambda r: (str(r.doc_id), r.text))
    plain = sorted(pii.personal_data(docs, model).collect(), key=lambda r: (str(r.doc_id), r.text))
    assert [tuple(r)[:4] for r in rows] == [tuple(r) for r in plain]
    assert all(r.doc_id == r.row.doc_id and r.text == (r.row.text or "") for r in rows)


KEY = r"([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"


def plain_secrets(text):
    found = [(m.start(), m.end(), 0) for m in
             re.finditer(KEY + r"[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", text) if len(m[2]) >= 6]
    found += [(m.start(), m.end(), 1) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), m.end(), 2) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_secrets(spark):
    chance = random.Random(4)
    parts = ["password", "PassWd", "secretoken", "token", "api_key", "ApiKey", "=", ":", " ", '"', "'", "abc123", "Xy/9",
             "AKIA", "ABCDEFGH12345678", "0123456789abcdef", "é", "ſecret", "\n"]
    texts = ["".join(chance.choice(parts) for _ in range(15)) for _ in range(1500)]
    rows = list(enumerate(texts)) + [(None if i is None else i + 10_000, t) for i, t in odd_rows()]
    found = {r.doc_id: r for r in secretscan.secret_digests(frame(spark, rows)).collect()}
    for i, t in rows[:1500]:
        expected = plain_secrets(t)
        assert found[i].base_sha256 == digest(listed(expected, secretscan.KINDS)), t
        assert [found[i].n_assign, found[i].n_access, found[i].n_hex] == [
            sum(s[2] == k for s in expected) for k in range(3)
        ]
    assert secretscan.secret_digests(frame(spark, [])).collect() == []


def test_checked_secrets():
    body = "a1B2c3D4e5" * 3
    good = body + secretscan.base_62(zlib.crc32(body.encode()), 6)
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    der = base64.b64encode(b"\x30\x05hello").decode()
    text = f"ghp_{good} ghp_{body}000000 npm_{good} {part({'alg': 'x'})}.{part({})}.sig eyJx.y.z\n" \
           f"-----BEGIN RSA PRIVATE KEY-----\n{der}\n-----END RSA PRIVATE KEY----- " \
           f"-----BEGIN PRIVATE KEY-----\n{der}aa\n-----END PRIVATE KEY-----"
    kinds = sorted(secretscan.KINDS[k] for _, _, k in secretscan.scan(text.encode()))
    assert kinds == ["github", "jwt", "npm", "pem"]


def test_digest_of_nothing():
    assert digest(listed([], pii.KINDS)) == hashlib.sha256(b"").hexdigest()


def test_contamination_gives_whole_rows_after_any_number_of_passes(spark):
    docs = frame(spark, [(1, "a b c d"), (1, "a b c d"), (2, None), (3, "x y"), (4, "c d e")])
    items = spark.createDataFrame([("p", "b c"), ("q", "d e"), (None, "x")], "item_id string, text string")
    for limit in (4_000_000, 3):
        found = decontaminate.contamination(docs, items, size=2, automaton_bytes=limit, rows=True)
        rows = sorted((r.doc_id, r.row.text or "", r.n_words, r.n_hit, tuple(r["items"])) for r in found.collect())
        assert rows == [
            (1, "a b c d", 4, 2, ("p",)), (1, "a b c d", 4, 2, ("p",)), (2, "", 0, 0, ()),
            (3, "x y", 2, 1, ()), (4, "c d e", 3, 2, ("q",)),
        ]
        assert found.schema["row"].dataType == docs.schema
