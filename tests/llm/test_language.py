import zlib

from evidra.llm import language as L


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = L.op3_language_id(spark, "/root/testdata/sf0.01").collect()
    assert len(rows) == len(truth) and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_edges_and_out_of_place_distance(spark):
    docs = spark.createDataFrame([(1, "the cat and the dog", "en", 0), (2, "le chat et le chien", "fr", 0), (3, None, "en", 1), (4, "12 !? ½", "en", 1), (5, "le chat", None, 1), (None, "the dog", None, 2), (7, "", "fr", 3)], "doc_id long, text string, lang string, score int")
    profiles = L.learn(docs)
    got = {r.doc_id: (r.lang_pred, r.score) for r in L.predict(docs, profiles).collect()}
    assert {k: v[0] for k, v in got.items()} == {1: "en", 2: "fr", 3: "und", 4: "und", 5: "fr", None: "en", 7: "und"}
    assert got[1][1] == 1.0 and got[3][1] == 0.0
    assert L.predict(docs.limit(0), profiles).count() == 0 and L.predict(docs, {}).where("lang_pred <> 'und'").count() == 0

    def plain(text, profile):
        from collections import Counter
        s = " " + " ".join("".join(c if c.isalpha() else " " for c in text.lower()).split()) + " "
        c = Counter(s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i : i + n] != " ")
        return sorted(c, key=lambda g: (-c[g], len(g), g))[:300]
    a, b = plain("the dog", None), plain("the cat and the dog", None)
    away = sum(min(abs(i - b.index(g)), 300) if g in b else 300 for i, g in enumerate(a))
    assert abs(got[None][1] - (1 - away / (300 * len(a)))) < 1e-12


def test_profiles_and_bounds_come_from_all_documents(spark):
    """9000 documents of one language, more than were once learned from: counts and bounds are those of plain code over all."""
    import random
    from collections import Counter
    rng = random.Random(3)
    texts = [" ".join("".join(rng.choices("abcdefghij", k=rng.randint(1, 6))) for _ in range(rng.randint(1, 9))) for _ in range(9000)]
    texts += [chr(0x430 + k) * 40 for k in range(9)]  # nine odd ones, whose letters nothing else has
    docs = spark.createDataFrame([(k, text, "en") for k, text in enumerate(texts)], "doc_id long, text string, lang string").repartition(3)
    counts: Counter = Counter()
    for text in texts:
        s = f" {text} "
        counts.update(s[i : i + n] for n in (1, 2, 3) for i in range(len(s) - n + 1) if s[i : i + n] != " ")

    def number(g):
        found = ord(g[0]) + (len(g) > 1)
        for c in g[1:]:
            found = found * L.BASE + ord(c)
        return found

    profiles = L.learn(docs)
    want = [number(g) for g in sorted(counts, key=lambda g: (-counts[g], len(g), g))[: L.PROFILE]]
    assert profiles["en"].tolist() == want
    ranker = L.Ranker(profiles, L.PROFILE)
    scores = sorted(ranker.predict(t)[1] for t in texts)
    at = next(s for k, s in enumerate(scores, 1) if k >= L.LOW * len(scores))
    assert L.least_scores(docs, profiles) == {"en": int(at * L.STEPS) / L.STEPS * L.MARGIN}
