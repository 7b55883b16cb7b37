import random

from filelake.llm import queries, toxicity

BAD = ["idiotish", "scummy", "trashed"]


def corpus(n=600, seed=4):
    random.seed(seed)
    words = ["".join(random.choices("abcdeghlmnprt", k=random.randint(2, 8))) for _ in range(400)]
    rows, labels, places = [], [], {}
    for i in range(n):
        sentences = [" ".join(random.choices(words, k=random.randint(3, 12))) for _ in range(random.randint(1, 30))]
        toxic = i % 6 == 0
        if toxic:
            at = random.randrange(len(sentences))
            sentences[at] += " " + random.choice(BAD).upper() + "! rest of it"
            places[i] = at
        rows.append((i, ". ".join(sentences)))
        labels.append((i, int(toxic)))
    return rows, labels, places


def test_learns_from_documents_and_finds_sentences(spark, docs):
    rows, labels, places = corpus()
    table = docs(rows + [(9000, None), (9001, ""), (9002, "one " * 100_000), (None, "clean words here"), (0, rows[0][1])])
    marked = spark.createDataFrame(labels + [(1, None), (None, 1), (77777, 1)], "doc_id long, toxic int")
    model = toxicity.train(table, marked.filter("doc_id is null or doc_id % 5 != 0"))
    scored = {}
    for r in toxicity.score(table, model).collect():
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.5)
        assert scored.setdefault(r["doc_id"], r["score"]) == r["score"]
        if r["doc_id"] in places and r["doc_id"] % 5 == 0:
            assert places[r["doc_id"]] in [s["number"] for s in r["sentences"]]
        elif r["doc_id"] in (9000, 9001, 9002, None):
            assert r["predicted"] == 0 and not r["sentences"]
    held = [(y, scored[i] >= 0.5) for i, y in labels if i % 5 == 0]
    assert sum(y == p for y, p in held) / len(held) > 0.97


def test_score_is_noisy_or_of_sentences():
    model = toxicity.Model({"bad": 5.0, "wor*": -1.0}, -3.0)
    text = "a bad thing. worse words\nnothing! bad bad"
    p = [toxicity._sigmoid(-3 + w) for w in (5.0, -2.0, 0.0, 10.0)]
    clean = 1.0
    for x in p:
        clean *= 1 - x
    assert abs(model.document(*model.scorer()(text)) - (1 - clean)) < 1e-9


def test_bound_of_the_sample(spark, docs):
    rows, labels, _ = corpus(300)
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    model = toxicity.train(docs(rows), marked, max_toxic=30, max_clean=60)
    assert sum(r["predicted"] for r in toxicity.score(docs(rows), model).collect()) >= 30


def test_no_labels_and_no_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    model = toxicity.train(docs([(1, "text")]), none)
    (row,) = toxicity.score(docs([(1, "text")]), model).collect()
    assert row["predicted"] == 0
    assert toxicity.score(docs([]), model).count() == 0
    assert toxicity.train(docs([]), spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")).weights == {}


def test_query_on_held_out_rows(spark):
    sf = "/root/testdata/sf0.1"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    found = queries.op10_toxicity(spark, sf).join(labels, "doc_id").filter("held_out").select("toxic", "predicted").collect()
    right = sum(r["toxic"] == r["predicted"] for r in found)
    assert right / len(found) > 0.97
    assert all(r["toxic"] for r in found if r["predicted"]) or sum(1 - r["toxic"] for r in found if r["predicted"]) < 0.01 * len(found)


def test_length_alone_is_no_evidence(spark):
    """Clean texts written a thousand times, and a hundred thousand other words, stay clean."""
    sf = "/root/testdata/sf0.01"
    documents, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    model = toxicity.train(documents, labels)
    assert model.weights
    score = model.scorer()
    clean = [r["text"] for r in documents.join(labels.filter("toxic = 0"), "doc_id").orderBy("doc_id").limit(40).collect()]
    once = [model.document(*score(t)) for t in clean]
    again = [model.document(*score((t + "\n") * 1000)) for t in clean]
    assert all(b < 0.5 for a, b in zip(once, again) if a < 0.5) and sum(a < 0.5 for a in once) >= 39
    assert model.document(*score(". ".join(f"{i} {i + 1}" for i in range(100_000)))) < 0.5
    assert model.document(*score(None)) == model.document(*score("1. 2. 3"))


def test_different_clean_documents_joined_stay_clean(spark):
    """Up to a megabyte of clean labelled documents, none of them repeated, and toxic ones among them are found."""
    sf = "/root/testdata/sf0.1"
    documents, labels = (spark.read.parquet(f"{sf}/{name}.parquet") for name in ("documents", "labels"))
    fold = "crc32(cast(doc_id as string)) % 5"
    model = toxicity.train(documents, labels.filter(f"{fold} != 0"))
    score = model.scorer()
    rows = documents.join(labels, "doc_id").orderBy("doc_id").selectExpr("doc_id", "toxic", "text", f"{fold} = 0 as held").collect()
    clean = [r["text"] for r in rows if not r["toxic"] and model.document(*score(r["text"])) < 0.5]
    assert len(clean) > 0.99 * sum(not r["toxic"] for r in rows)
    for size in (10**5, 3 * 10**5, 10**6):
        text, at = "", 0
        while len(text) < size and at < len(clean):
            text, at = text + "\n" + clean[at], at + 1
        assert model.document(*score(text)) < 0.5, size
    bad = [r["text"] for r in rows if r["toxic"] and r["held"]]
    alone = [model.document(*score(t)) >= 0.5 for t in bad]
    inside = [model.document(*score("\n".join([*clean[:40], t, *clean[40:80]]))) >= 0.5 for t in bad]
    assert sum(alone) >= 0.9 * len(bad) and sum(inside) >= 0.95 * sum(alone)


def test_a_repeated_id_gives_one_document(spark, docs):
    rows, labels, _ = corpus(200)
    marked = spark.createDataFrame(labels, "doc_id long, toxic int")
    once = toxicity.train(docs(rows), marked)
    again = toxicity.train(docs(rows + [rows[3]] * 50), marked)
    assert once.weights.keys() == again.weights.keys()
