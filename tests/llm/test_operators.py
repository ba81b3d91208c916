from __future__ import annotations

import collections
import hashlib
import random
import re
from array import array

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from incidara.llm import (
    bpe,
    components,
    decontaminate,
    kdshards,
    lines,
    neighbours,
    pii,
    repeats,
    simhash,
    toxicity,
    warc,
)
from incidara.llm.registry import ORACLE, QUERIES, tokenizer_source

SF = "/root/testdata/sf0.001"
CLASHING = "key long, u long, name string, n int, span string, id long, `order` string"


def awkward_texts() -> list[tuple]:
    """Nulls, empty and long texts, ties, repeated rows, letters of several scripts."""
    line = "the quick brown fox jumps over the lazy dog and runs away again"
    passage = " ".join(f"w{i}" for i in range(60))
    rows = [
        (1, None),
        (2, ""),
        (3, " \n \n"),
        (4, f"{line}\n{passage}\nlast"),
        (5, f"{line}\n{passage}\nother"),
        (6, f"{line}\n{passage}\nlast"),
        (7, "été 中文 😀 \r\n\x00 end"),
        (8, ("ab " * 40_000)),
        (9, "x" * 5000),
        (10, "x" * 5000),
        (11, "ONE two"),
        (11, "ONE two"),
        (None, "one TWO"),
        (None, None),
        (12, passage.upper()),
    ]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(*r, *([None] * 7)) for r in awkward_texts()]
    return spark.createDataFrame(rows, f"doc_id long, text string, {CLASHING}").repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], f"doc_id long, text string, {CLASHING}")


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


# nearest neighbours -----------------------------------------------------------


def brute_nearest(rows, k):
    clean = {
        i: np.array(v, float)
        for i, v in rows
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)
    }
    out = []
    for q, a in clean.items():
        if q % 3 == 0:
            scored = []
            for c, b in clean.items():
                if c != q and len(b) == len(a):
                    total = 0.0
                    for x, y in zip(a, b):
                        total += x * y
                    scored.append((-total, c))
            out += [(q, r, c, -s) for r, (s, c) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("block_rows", [16, 4096])
def test_neighbours_are_exact(spark, block_rows):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=8).astype(np.float32).tolist()) for i in range(120)]
    rows += [(200 + i, rows[3][1]) for i in range(40)]  # ties
    rows += [(300, None), (301, []), (302, [0.0] * 8), (303, [float("nan")] * 8), (304, [None] * 8)]
    rows += [(306, [float("inf")] + [0.0] * 7), (None, rows[0][1]), (309, [1e-40] * 8), (312, [1.0, 2.0])]
    table = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<float>, id int")
    found = neighbours.nearest(table, F.col("vec_id") % 3 == 0, k=5, block_rows=block_rows)
    assert sorted(map(tuple, found.collect())) == brute_nearest(
        [(r.vec_id, r.embedding) for r in table.collect()], 5
    )


@pytest.mark.parametrize("block_rows", [3, 4096])
def test_rows_that_share_an_id_are_all_neighbours(spark, block_rows):
    rng = np.random.default_rng(2)
    rows = [(int(rng.integers(0, 6)), [float(x) for x in rng.integers(-2, 3, 2)]) for _ in range(40)]
    rows += [(3, [1.0, 1.0])] * 30 + [(1, [1.0, 0.0]), (1, [0.5, 0.5])]
    rows = [r for r in rows if any(r[1])]
    want = []
    for i, (q, a) in enumerate(rows):
        if q % 3 == 0:
            scored = sorted((-(a[0] * b[0] + a[1] * b[1]), c) for j, (c, b) in enumerate(rows) if i != j)
            want += [(q, rank, c, -s) for rank, (s, c) in enumerate(scored[:5], 1)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, row string")
    found = neighbours.nearest(table, F.col("vec_id") % 3 == 0, k=5, block_rows=block_rows)
    assert sorted(map(tuple, found.collect())) == sorted(want)


def test_neighbours_of_nothing(spark):
    table = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert neighbours.nearest(table, F.lit(True)).count() == 0


# decontamination -----------------------------------------------------------


def brute_hits(text, items, window):
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    hit, found = set(), set()
    for item, item_text in items:
        if item is None or item_text is None:
            continue
        iw = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", item_text.translate({c: c + 32 for c in range(65, 91)}))
        size = min(window, len(iw))
        wins = {tuple(iw[i : i + size]) for i in range(len(iw) - size + 1)} if size else set()
        for i in range(len(words) - size + 1):
            if tuple(words[i : i + size]) in wins:
                hit.update(range(i, i + size))
                found.add(str(item))
    return len(words), len(hit), sorted(found)


@pytest.mark.parametrize("shard_words", [20, 10**6])
def test_suffix_automaton_equals_brute_force(spark, shard_words):
    rng = random.Random(5)
    vocabulary = ["a", "b", "B", "cé", "d1"]
    make = lambda n: " ".join(rng.choice(vocabulary) + rng.choice(["", ",", "."]) for _ in range(n))
    items = [(i, make(rng.randint(0, 9))) for i in range(12)] + [(3, "b a"), (None, "a"), (99, None)]
    texts = [(i, make(rng.randint(0, 60))) for i in range(40)] + [(90, None), (91, "")]
    got = decontaminate.audit(
        spark.createDataFrame(texts, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string"),
        window=4,
        shard_words=shard_words,
    )
    want = []
    for doc, text in texts:
        n, hits, found = brute_hits(text, items, 4)
        digest = hashlib.sha256(",".join(found).encode()).hexdigest()
        want.append((doc, n, hits, len(found), digest, hits > 0))
    assert rows_of(got) == sorted(want, key=str)


def test_decontaminate_cuts_spans_and_keeps_columns(spark, docs, empty):
    items = spark.createDataFrame([(1, " ".join(f"W{i}" for i in range(20, 40)))], "item_id long, text string")
    out = decontaminate.decontaminate(docs, items)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert "w19  w40" in texts[4] and "w20" not in texts[4]
    assert texts[7] == "été 中文 😀 \r\n\x00 end" and texts[1] is None
    assert decontaminate.decontaminate(empty, items).count() == 0
    assert decontaminate.decontaminate(docs, items.limit(0)).count() == docs.count()


def test_helper_names_may_be_taken(spark):
    """Operators that return their input's columns bear any ``__`` name that they use themselves."""
    names = ["__id", "__sum", "__sum1", "__sum2", "__score", "__toxic", "__runs", "__items", "__n_words", "__later"]
    names += ["__kept", "__digest", "__spans", "__map", "aside_0", "Aside_1"]
    rows = [(i, t, *[f"{n} {i}" for n in names]) for i, t in awkward_texts()]
    table = spark.createDataFrame(rows, ["doc_id", "text", *names])
    items = spark.createDataFrame([(1, " ".join(f"W{i}" for i in range(20, 40)))], "item_id long, text string")
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    plain = table.select("doc_id", "text")
    for operate in (
        lambda df: toxicity.drop_toxic(df, labels),
        lambda df: decontaminate.decontaminate(df, items),
        lambda df: pii.replace(df, b"key").drop("__found", "__kinds"),
        lines.drop_later_runs,
        repeats.remove_repeats,
        simhash.keep_one,
    ):
        out = operate(table)
        assert out.columns == table.columns
        got = out.collect()
        assert rows_of(out.select("doc_id", "text")) == rows_of(operate(plain))
        assert all(r[n] == f"{n} {r.doc_id}" for r in got for n in names)


# personal data -----------------------------------------------------------


def test_surrogates_are_consistent_distinct_and_of_the_same_format(spark, docs, empty):
    text = (
        "Mrs. Anna Meyer (anna.meyer@firm.de, +1 (546) 555-9275) met Herr Meyer; Mrs. Meyer pays with "
        "4111 1111 1111 1111 from 10.1.2.3, token = \"ede43f42c939b6405768150e0411590525cf889e\"."
    )
    rows = [(1, text, "x"), (2, "Write to ANNA.MEYER@firm.de or +15465559275.", "y"), (3, "nothing here, 1.2.3.400", None)]
    out = {r.doc_id: r for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string, kind string"), b"k").collect()}
    kinds = [(k, v) for _, _, k, v in pii.find(out[1].text)]
    assert [k for k, _ in kinds] == [k for _, _, k, _ in pii.find(text)]
    old = {v for _, _, _, v in pii.find(text)}
    assert not old & {v for _, v in kinds}
    family = [v for k, v in kinds if k.startswith("family")]
    assert len(family) == 3 and len(set(family)) == 1
    given = next(v for k, v in kinds if k.startswith("given"))
    assert given.capitalize() in pii.GIVEN["latin", "f"]
    card = next(v for k, v in kinds if k == "card")
    assert pii._luhn(card) == 0 and re.search(r"\d{4} \d{4} \d{4} \d{4}", out[1].text)
    assert next(v for k, v in kinds if k == "ip").startswith("10.")
    again = [v for _, _, _, v in pii.find(out[2].text)]
    assert again == [next(v for k, v in kinds if k == "email"), next(v for k, v in kinds if k == "phone")]
    assert out[3].text == rows[2][1] and out[3].kind is None and out[3]["__found"] == 0
    same = pii.replace(docs, b"k").drop("__found", "__kinds")
    assert rows_of(same) == rows_of(docs) and pii.replace(empty, b"k").count() == 0


def test_surrogates_never_meet(spark):
    # a format of a hundred values with forty entities: draws collide and are repeated
    rows = [("secret", f"{i:02d}") for i in range(40)]
    table = pii.surrogates(spark.createDataFrame(rows, "kind string, value string"), b"k", rounds=200)
    found = table.collect()
    new = {r.surrogate for r in found}
    assert len(new) == 40 and not new & {r.value for r in found} and max(r.attempt for r in found) > 0


def test_later_mentions_without_a_title_are_the_same_person(spark):
    rows = [
        (1, "Meyer was late. Mrs. Anna Meyer met Tom. Meyer paid; Anna's bag, MEYER-Haus, meyer, Meyerson and Meyer2 stay."),
        (2, "Mr. O'Neil-Smith's car. O'Neil-Smith drove."),
        (3, "Meyer has no title here."),
        (4, "Пришла госпожа Анна Петрова. Петрова ушла."),
        (5, "Ήρθε η κυρία Ελένη Παππά. Η Παππά έφυγε."),
        (6, "Call ٠٣٠ ١٢٣٤ ٥٦٧٨ now."),
        (7, "x" + ", Mrs. Anna Meyer" * 2000 + ", Meyer" * 2000),
    ]
    out = {r.doc_id: r for r in pii.replace(spark.createDataFrame(rows, "doc_id long, text string"), b"k").collect()}
    family = re.search(r"Mrs\. (\w+) (\w+) met", out[1].text)
    given, family = family[1], family[2]
    assert {given, family}.isdisjoint({"Anna", "Meyer"})
    assert out[1].text == (
        f"{family} was late. Mrs. {given} {family} met Tom. {family} paid; {given}'s bag, {family.upper()}-Haus, "
        "meyer, Meyerson and Meyer2 stay."
    )
    assert out[1]["__found"] == 6 and out[1]["__kinds"] == "family,given"
    name = re.fullmatch(r"Mr\. (.+)'s car\. (.+) drove\.", out[2].text)
    assert name[1] == name[2] and "Neil" not in out[2].text
    assert out[3].text == rows[2][1]
    for doc, old in ((4, ("Анна", "Петрова")), (5, ("Ελένη", "Παππά"))):
        assert not any(word in out[doc].text for word in old)
        words = re.findall(r"\w+", out[doc].text)
        assert words[3 + (doc == 5)] in words[4 + (doc == 5) :] and words[2 + (doc == 5)] in pii.GIVEN[("cyrillic", "greek")[doc - 4], "f"]
    assert re.fullmatch(r"Call [٠-٩]{3} [٠-٩]{4} [٠-٩]{4} now\.", out[6].text) and out[6].text != rows[5][1]
    assert out[7]["__found"] == 6000 and "Meyer" not in out[7].text


def test_titles_that_follow_each_other():
    def people(text):
        return [(text[a:b], kind) for a, b, kind, _ in pii.find(text)]

    family = "family-latin"
    assert people("Mrs Meyer and Mr Rose left") == [("Meyer", family), ("Rose", family)]
    assert people("Mr. Smith and Mrs. Jones spoke to Dr. Brown") == [("Smith", family), ("Jones", family), ("Brown", family)]
    assert people("Herr Weber und Frau Klein") == [("Weber", family), ("Klein", family)]
    assert people("Mr Smith Mrs Jones") == [("Smith", family), ("Jones", family)]
    assert people("Frau Prof. Dr. Eva Klein kam") == [("Eva", "given-f-latin"), ("Klein", family)]
    assert people("Prof. Dr. Weber") == [("Weber", family)]
    assert people("Mr Don Smith, Mr Don") == [("Don", "given-m-latin"), ("Smith", family), ("Don", family)]
    assert [p for p, _ in people("г-н Иванов и г-жа Петрова")] == ["Иванов", "Петрова"]
    assert people("Mr smith, Dr. Mrs. and Miss") == []


def test_a_full_format_widens(spark):
    # more than half of 192.168.x.y: no distinct surrogates that are not real are left in it
    rows = [("ip", f"192.168.{i // 256}.{i % 256}") for i in range(40_000)] + [("secret", f"{i:02d}") for i in range(95)]
    rows += [("email", f"a@firm{i}.com") for i in range(3000)] + [("secret", "------------------a")]
    found = pii.surrogates(spark.createDataFrame(rows, "kind string, value string"), b"k").collect()
    new = {(r.kind, r.surrogate) for r in found}
    assert len(found) == len(new) == len(rows) and not new & {(r.kind, r.value) for r in found}
    assert all(r.surrogate.startswith(("192.168.", "10.", "24", "25")) for r in found if r.kind == "ip")
    assert {k for _, _, k, _ in pii.find("key = ----------------------")} == set()
    assert pii._in_format("ssn", "123-45-6789", "9876543210") == "987-65-43210"
    # from any attempt on, what a surrogate is written as is found again as one of its kind
    for kind, value in (("ip", "192.168.1.2"), ("ip", "10.0.0.1"), ("ip", "8.8.8.8"), ("email", "a@b.com")):
        for attempt in range(40):
            new = pii.surrogate(kind, value, attempt, b"k")
            assert [(k, v) for _, _, k, v in pii.find(new)] == [(kind, new)]


# toxicity -----------------------------------------------------------


def test_toxicity_on_held_out_documents(spark):
    sf = "/root/testdata/sf0.01"
    found = QUERIES["op4_instance_toxicity"](spark, sf)
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    rows = found.filter("held_out").join(labels, "doc_id").collect()
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.6 * len(toxic)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.02 * len(rows)


def test_toxicity_finds_sentences_and_survives_odd_rows(spark, docs, empty):
    rows = [(i, "A fine day. " * (i % 4) + ("You utter fool! " if i % 3 == 0 else "") + "It rains.") for i in range(90)]
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i, _ in rows] + [(None, 1), (5, None)], "doc_id long, toxic int")
    model = toxicity.fit(texts, labels)
    found = {(r.doc_id, r.sentence) for r in toxicity.offending(texts, model).collect()}
    assert found == {(i, "you utter fool") for i, _ in rows if i % 3 == 0}
    out = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
    assert all(0 <= r["__score"] <= 1 for r in out.values()) and out[2]["__sentences"] == 0
    assert toxicity.audit(empty, labels).count() == 0
    assert toxicity.audit(docs, labels.limit(0)).filter("score BETWEEN 0 AND 1").count() == docs.count()
    assert rows_of(toxicity.drop_toxic(docs, labels)) == rows_of(docs)


def test_toxicity_does_not_grow_with_length(spark):
    sf = "/root/testdata/sf0.01"
    texts, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    scorer = toxicity.Scorer(toxicity.fit(texts, labels))
    rows = texts.join(labels, "doc_id").filter("text IS NOT NULL").select("toxic", "text").collect()
    clean = [r.text for r in rows if r.toxic == 0 and scorer.text(r.text)[0] < toxicity.THRESHOLD]
    long = "\n".join(clean * 5)
    worst = min((s for r in rows if r.toxic for s in toxicity.sentences_of(r.text)), key=scorer.sentence)
    assert len(long) > 3_000_000
    assert scorer.text(long)[0] < toxicity.THRESHOLD
    assert scorer.text("It rains.\n" * 300_000)[0] < toxicity.THRESHOLD
    for at in (0, len(clean) // 2, len(clean)):
        assert scorer.text("\n".join([*clean[:at], worst, *clean[at:]] + clean * 4))[0] >= toxicity.THRESHOLD


def test_toxicity_is_one_noisy_or_wherever_sentences_stand():
    bad = [f"b{i}" for i in range(40)]
    scorer = toxicity.Scorer({"weights": dict.fromkeys(bad, 1.2) | {"fine": -1.0}, "bias": -1.0, "leak": -9.0})
    q = 1 / (1 + np.exp(-0.2))
    p = (q - toxicity.MILD) / (1 - toxicity.MILD)
    expected = 1 - (1 - 1 / (1 + np.exp(9.0))) * (1 - p) ** 40
    for between in ("", "fine day\n" * 63, "rain\n" * 5_000):
        assert scorer.text("\n".join(word + "\n" + between for word in bad))[0] == pytest.approx(expected)
    # the same evidence counts once, and mild sentences not at all
    assert scorer.text("b1 day\n" * 40)[0] == pytest.approx(scorer.text("b1")[0])
    assert scorer.text("fine b1\n" * 200_000)[0] == scorer.text("")[0]


# SimHash -----------------------------------------------------------


def brute_print(text):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints):
    parent = list(range(len(prints)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= 2:
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(prints))]


def test_golay_masks_are_the_codewords_within_four():
    masks = simhash.golay_masks()
    words = np.arange(1 << 12, dtype=np.int64) << 11
    words |= simhash._remainder(words)
    rng = random.Random(2)
    for _ in range(200):
        x = rng.getrandbits(23)
        near = {int(w) for w in words if (int(w) ^ x).bit_count() <= 4}
        row = masks[simhash._remainder(np.array([x]))[0]]
        assert near == {x ^ int(m) for m in row if m >= 0}


@pytest.mark.parametrize("bucket", [1, 64])
def test_links_join_what_two_bits_join(spark, bucket):
    rng = random.Random(7)
    prints = [rng.getrandbits(64) for _ in range(30)]
    for _ in range(120):
        prints.append(rng.choice(prints) ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)))
    prints = list(dict.fromkeys(prints))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    found = components.components(simhash.links(spark.createDataFrame([(p,) for p in signed], "u long"), bucket))
    root = {p: p for p in signed} | {r.node: r.root for r in found.collect()}
    got, want = collections.defaultdict(set), collections.defaultdict(set)
    for i, (p, r) in enumerate(zip(signed, brute_components(prints))):
        got[root[p]].add(i)
        want[r].add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_simhash_of_the_table_and_of_odd_rows(spark, docs, empty):
    table = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    for source in (table, docs):
        rows = [(r.doc_id, r.text) for r in source.select("doc_id", "text").collect()]
        prints = [brute_print(t) for _, t in rows]
        groups = brute_components(prints)
        least = {g: min((d for (d, _), h in zip(rows, groups) if h == g and d is not None), default=None) for g in groups}
        want = [(d, f"{p:016x}", least[g]) for (d, _), p, g in zip(rows, prints, groups)]
        assert rows_of(simhash.near_duplicates(source)) == sorted(want, key=str)
    assert simhash.near_duplicates(empty).count() == 0
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns and {1, 4, 11} <= {r.doc_id for r in kept.collect()}
    assert 2 not in {r.doc_id for r in kept.collect()}


def test_keep_one_keeps_a_row_of_each_component(spark):
    rng = random.Random(5)
    texts = [" ".join(rng.choices("abcdefghijklmnop", k=40)) for _ in range(8)]
    rows = [(None, t) for t in texts[:5]]  # unique, without an id
    rows += [(None, texts[5]), (3, texts[5].upper())]  # a copy of a numbered document
    rows += [(1, texts[6]), (0, texts[6].upper()), (1, texts[7]), (1, texts[7])]  # an id of two texts
    rows += [(None, texts[0])]
    kept = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    want = [*((None, t) for t in texts[:5]), (3, texts[5].upper()), (0, texts[6].upper()), (1, texts[7])]
    assert rows_of(kept) == sorted(want, key=str)


# repeated bytes -----------------------------------------------------------


def brute_repeats(rows, length):
    count = collections.Counter()
    for _, text in rows:
        data = (text or "").encode()
        count.update(data[i : i + length] for i in range(len(data) - length + 1))
    out = []
    for doc, text in rows:
        data = (text or "").encode()
        mark, last = bytearray(len(data)), 0
        for i in range(len(data) - length + 1):
            if count[data[i : i + length]] > 1:
                first = max(i, last)
                mark[first : i + length] = b"\1" * (i + length - first)
                last = i + length
        kept = bytes(b for b, m in zip(data, mark) if not m)
        runs = [r for r in bytes(mark).split(b"\0") if r]
        out.append((doc, len(data), sum(mark), len(runs), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("limits", [{}, {"hot_gram": 1}, {"batch": 1}])
def test_repeats_equal_brute_force(spark, limits):
    rng = random.Random(3)
    parts = ["".join(rng.choice("abcé") for _ in range(90)) for _ in range(6)]
    pick = lambda: rng.choice([rng.choice(parts), "x" * rng.randint(0, 150), "abab" * rng.randint(0, 30), f"q{rng.random()}"])
    rows = [(i, "".join(pick() for _ in range(rng.randint(0, 6)))) for i in range(80)]
    rows += [(500, None), (501, ""), (None, parts[0] + parts[1]), (7, parts[2] + "zz"), rows[5], rows[5]]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    assert rows_of(repeats.audit(table, 64, gram=16, **limits)) == brute_repeats(rows, 64)


def test_repeats_of_odd_rows(docs, empty):
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert rows_of(repeats.audit(docs, 64, gram=16)) == brute_repeats(rows, 64)
    assert repeats.audit(empty).count() == 0
    out = repeats.remove_repeats(docs)
    assert out.columns == docs.columns and {r.doc_id: r.text for r in out.collect()}[9] == ""


def test_query_of_repeats_shows_the_text_that_stays(spark, tmp_path):
    rng = random.Random(5)
    words = lambda n: " ".join("".join(rng.choice("abcdé") for _ in range(7)) for _ in range(n))
    passage, short = words(60), words(30)  # over and under 400 bytes
    rows = [(0, f"one {passage} A"), (1, f"two {passage} B"), (2, words(80)), (3, f"C {short}"), (4, f"D {short}")]
    rows += [(5, ""), (6, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    table.write.parquet(f"{tmp_path}/documents.parquet")
    out = {r.doc_id: r for r in QUERIES["op6_column_wise_repeats"](spark, str(tmp_path)).collect()}
    left = dict(rows) | {0: "oneA", 1: "twoB"}  # the blanks beside the passage repeat as well
    assert {k: r.text for k, r in out.items()} == left
    assert sorted((tuple(r)[:5] for r in out.values()), key=str) == brute_repeats(rows, 400)
    kept = repeats.remove_repeats(table)
    assert {r.doc_id: r.text for r in kept.collect()} == left


# byte-level BPE -----------------------------------------------------------


@pytest.fixture(scope="module")
def library():
    import public_tokenizers
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def test_transducer_equals_the_library(library):
    rng = random.Random(4)
    tables = bpe.load(tokenizer_source())
    words = bpe.Words(tables)
    for n in range(600):
        letters = rng.choice(["ab", "a", "the an", "aàé ñ中😀", "xyzXYZ019 \n\t", "   \n  a", "-=_*#'s", "   a"])
        text = "".join(rng.choice(letters) for _ in range(rng.choice([3, 20, 700])))
        text += "<|endoftext|>" * (n % 40 == 0) + text[: n % 5]
        ids = array("I", b"".join(bpe.encode(text, words)))
        assert ids.tolist() == library.encode(text, add_special_tokens=False).ids, text
        assert "".join(bpe.decode([ids.tobytes()], tables["table"])) == text


def test_stream_keeps_little_and_decodes_broken_bytes(library):
    tables = bpe.load(tokenizer_source())
    machine = bpe.Transducer(tables)
    text = "".join(random.Random(1).choice("abcdest") for _ in range(30_000))
    parts = [text[i : i + 7].encode() for i in range(0, len(text), 7)]
    assert list(machine.stream(parts, bpe.STEP)) == library.encode(text, add_special_tokens=False).ids
    assert tables["lookahead"] <= 2 * bpe.STEP
    ids = [library.token_to_id("Ã"), library.token_to_id("A")]  # a first byte without its second
    assert "".join(bpe.decode([array("I", ids).tobytes()], tables["table"])) == library.decode(ids, skip_special_tokens=False)


def test_whole_pieces_equal_streamed_ones():
    machine = bpe.Transducer(bpe.load(tokenizer_source()))
    rng = random.Random(7)
    for n in range(2_000):
        letters = rng.choice([b"ab", b" aeinrst", b"-=*", "é中😀".encode(), b"0123456789", bytes(range(256))])
        data = bytes(rng.choice(letters) for _ in range(rng.choice([1, 4, 12, 90])))
        assert machine.whole(data) == list(machine.stream([data], 1 + n % 9)), data


def test_bpe_round_trip_of_odd_rows(docs, empty, library):
    got = rows_of(bpe.round_trip(docs, tokenizer_source()))
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        text = library.decode(ids, skip_special_tokens=False)
        sums = (hashlib.sha256(b).hexdigest() for b in (array("I", ids).tobytes(), text.encode()))
        want.append((r.doc_id, len(ids), *sums))
    assert got == sorted(want, key=str)
    assert bpe.round_trip(empty, tokenizer_source()).count() == 0
    ids = bpe.token_ids(docs, tokenizer_source())
    assert rows_of(bpe.texts_of(ids, tokenizer_source())) == rows_of(docs.selectExpr("doc_id", "coalesce(text, '') AS text"))


# lines -----------------------------------------------------------


@pytest.mark.parametrize("min_lines", [1, 2, 3, 4])
def test_line_runs_equal_brute_force(spark, min_lines):
    rng = random.Random(min_lines)
    rows = [(i, "\n".join(rng.choice(["a", "b", "c", "", " ", f"u{rng.randint(0, 40)}"]) for _ in range(rng.randint(0, 12)))) for i in range(60)]
    seen, gone = set(), collections.defaultdict(set)
    for doc, text in rows:
        at = [(i, x) for i, x in enumerate(text.split("\n")) if x.strip()]
        for p in range(len(at) - min_lines + 1):
            name = tuple(x for _, x in at[p : p + min_lines])
            if name in seen:
                gone[doc].update(i for i, _ in at[p : p + min_lines])
            seen.add(name)
    want = [
        (doc, "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone[doc])) for doc, text in rows
    ]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    found = lines.without_later_runs(table, min_lines)
    assert rows_of(found.select("doc_id", "__kept")) == sorted(want, key=str)


def test_line_runs_of_odd_rows(docs, empty):
    out = lines.drop_later_runs(docs)
    assert out.columns == docs.columns
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[4].endswith("last") and texts[5] == "other" and 6 not in texts
    assert texts[1] is None and texts[2] == "" and texts[3] == " \n \n"
    assert lines.audit(docs).count() == docs.count() and lines.audit(empty).count() == 0


# shards -----------------------------------------------------------


def check_shards(rows, count, slack):
    size = collections.Counter()
    slots = collections.defaultdict(list)
    for r in rows:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(size) <= set(range(count))
    mean = sum(size.values()) / count
    assert all(abs(size[s] - mean) <= slack for s in range(count))


def test_shards_are_near_equal_in_bytes(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    rows = kdshards.shards(table).collect()
    assert len(rows) == table.count()
    check_shards(rows, 8, 3 * max(r.size for r in rows))
    copies = spark.range(4000).selectExpr("id AS doc_id", "'same text' AS text", "'en' AS lang", "'s' AS source")
    check_shards(kdshards.shards(copies, 5).collect(), 5, 30)


def test_shards_of_odd_rows(docs, empty):
    rows = kdshards.shards(docs).collect()
    assert len(rows) == docs.count() and {r.law for r in rows} == {"bytes"}
    assert sum(r.size for r in rows) == sum(len((t or "").encode()) + 1 for _, t in awkward_texts())
    check_shards(rows, 8, 10**9)
    assert kdshards.shards(empty).count() == 0


@pytest.mark.parametrize("same", [600, 5000])
def test_shards_part_rows_that_repeat(spark, same):
    table = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("cast(doc_id as long) doc_id", "text", "lang", "source")
    equal = spark.range(same).selectExpr("cast(null as long)", f"repeat('same words ', {900_000 // same})", "'en'", "'s'")
    rows = kdshards.shards(table.union(equal)).collect()
    assert len(rows) == table.count() + same
    check_shards(rows, 8, 3 * max(r.size for r in rows))
    alike = collections.Counter(r.shard for r in rows if r.doc_id is None)
    assert len(alike) > 1


# archives -----------------------------------------------------------


def test_loser_tree_merges():
    rng = random.Random(9)
    for k in range(0, 9):
        runs = [sorted(rng.randint(0, 20) for _ in range(rng.randint(0, 9))) for _ in range(k)]
        merged = list(warc.LoserTree([[(x,) for x in run] for run in runs], key=lambda r: r))
        assert [x for (x,) in merged] == sorted(x for run in runs for x in run)


def test_archives_round_trip_odd_pages(spark):
    big = "<p>\r\n\r\nWARC/1.1\r\n\r\n" + "é" * 800
    rows = [
        (1, "http://www.A.example.com:80/x/?b=2&a=1#f", big),
        (2, "https://a.example.com/x?a=1&b=2", big),
        (5, None, big),
        (3, "http://b.example.org/line\nbreak", "short"),
        (4, "not a url", "short"),
        (6, "", None),
        (None, "http://b.example.org/", "x" * 2000),
        (7, "http://b.example.org/", "x" * 2000),
        (7, "http://b.example.org/", "x" * 2000),
    ]
    pages = spark.createDataFrame([(*r, 0) for r in rows], "page_id long, url string, html string, digest int")
    got = warc.archive_round_trip(pages, archive_bytes=4000, range_rows=3).collect()
    assert [(r.url_key, r.stamp) for r in got] == sorted((r.url_key, r.stamp) for r in got)
    assert {r.url_key for r in got if r.page_id in (1, 2)} == {"com,example,a)/x?a=1&b=2"}
    kept = {}
    for page, _, html in rows:
        data = (html or "").encode()
        if len(data) >= 1000 and page is not None:
            kept[data] = max(kept.get(data, page), page)
    want = []
    for page, _, html in rows:
        data = (html or "").encode()
        other = kept.get(data) if page is None or kept.get(data) != page else None
        want.append((page, len(data), hashlib.sha1(data).hexdigest(), "revisit" if other else "response", other))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(want, key=str)
    assert warc.archive_round_trip(pages.limit(0)).count() == 0


def test_archives_keep_the_date_of_a_page(spark):
    rows = [(1, "2011-05-06 07:08:09"), (2, None), (3, "no date")]
    pages = spark.createDataFrame([(i, "http://a.example.org/", "x", d) for i, d in rows], "page_id long, url string, html string, date string")
    got = {r.page_id: r.stamp for r in warc.archive_round_trip(pages).collect()}
    assert got == {1: "20110506070809", 2: "20200101000002", 3: "20200101000003"}
    assert [r.stamp for r in warc.archive_round_trip(pages.filter("page_id = 1").withColumn("date", F.to_timestamp("date"))).collect()] == ["20110506070809"]


def test_archives_are_bounded_whatever_repeats(spark):
    small, big = (None, "http://a.example.org/", "<p>again</p>"), (9, "http://b.example.org/", "y" * 3000)
    rows = [small] * 200 + [big] * 60 + [(i, None, f"page {i}") for i in range(20)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3, "page_id")
    got = warc.archive_round_trip(pages, archive_bytes=12_000).collect()
    assert collections.Counter(r.page_id for r in got) == collections.Counter(page for page, _, _ in rows)
    held, sizes = collections.Counter(r.archive for r in got), collections.Counter()
    for r in got:
        sizes[r.archive] += r.length
    assert max(held.values()) <= 20 and max(sizes.values()) <= 3 * 12_000


# all -----------------------------------------------------------


def test_pipeline_stages_take_effect(spark):
    table = spark.read.parquet(f"{SF}/documents.parquet")
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    ids = [r.doc_id for r in result.collect()]
    assert len(ids) == len(set(ids)) and set(ids) < {r.doc_id for r in table.select("doc_id").collect()}
    for _, step in corpus_pipeline.STAGES[:-1]:
        assert step(spark, table, SF).columns == table.columns


def test_each_query_has_sql_or_a_test_above():
    assert {name.split("_")[0] for name in QUERIES} == {f"op{n}" for n in range(1, 14)}
    assert set(ORACLE) <= set(QUERIES)
