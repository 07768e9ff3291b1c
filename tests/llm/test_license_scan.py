import random

from foliant.llm import license_scan as L


def brute(docs, templates, contained):
    out = set()
    for i, text in docs:
        w = L.words_of(text or "")
        for name, t in templates.items():
            tw = L.words_of(t)
            want = L.shingles_of(tw)
            for p in range(len(w)):
                part = w[p : p + len(tw)]
                size = min(L.SIZE, len(tw))
                have = {" ".join(part[k : k + size]) for k in range(len(part) - size + 1)}
                if len(want & have) >= contained * len(want):
                    out.add((i, name))
                    break
    return out


def test_against_brute_force(spark):
    fill = " ".join(f"w{i}" for i in range(300))
    docs = [(k, f"{fill[: 7 * k]} {t} {fill[: 5 * k]}") for k, t in enumerate(L.TEMPLATES.values())]
    grant = L.TEMPLATES["MIT-grant"]
    docs += [(100, grant.replace("merge", "join")), (101, grant[: len(grant) // 2]), (102, None), (103, ""), (104, "license " * 5000), (105, "LICENSED UNDER CC-BY 4.0"), (106, f"{fill}\n" * 30 + L.TEMPLATES["GPL-3.0"])]
    df = spark.createDataFrame([*docs, docs[0]], "doc_id long, text string").selectExpr("*", "1 as words", "'x' as license")
    got = L.license_scan(df).collect()
    assert {(r.doc_id, r.license) for r in got} == brute(docs, L.TEMPLATES, L.CONTAINED)
    assert len(got) == len({(r.doc_id, r.license) for r in got})
    assert L.license_scan(df.limit(0)).count() == 0


def test_cover_words_lose_nothing():
    cover = L.cover_words(L.TEMPLATES, L.CONTAINED)
    for t in L.TEMPLATES.values():
        s = L.shingles_of(L.words_of(t))
        free = {x for x in s if not any(c in x for c in cover)}
        assert len(free) < L.CONTAINED * len(s)


def test_bands_follow_the_shingles():
    assert L.bands_for("Released under the MIT License.", 0.8) == 180  # one of 20 shingles
    for t in L.TEMPLATES.values():
        words = L.words_of(t)
        wanted, window = len(words) - 4, 3 * L.size_class(len(words)) - 4
        held = -(-8 * wanted // 10)
        assert (1 - held / (window + wanted - held)) ** L.bands_for(t, 0.8) <= 1.0001e-4


def test_every_template_at_many_places(spark):
    """Unlike words around each template, at the beginning, within and at the end; short ones most often."""
    rng = random.Random(5)
    fill = lambda n: " ".join(f"q{rng.randrange(10**6)}" for _ in range(n))
    want, docs = set(), []
    for name, t in L.TEMPLATES.items():
        for k in range(300 if len(L.words_of(t)) <= 6 else 9):
            i = len(docs)
            docs.append((i, f"{fill((0, rng.randrange(300), 40)[k % 3])} {t} {fill((60, rng.randrange(300), 0)[k % 3])}"))
            want.add((i, name))
    got = L.license_scan(spark.createDataFrame(docs, "doc_id long, text string").repartition(8)).collect()
    assert want <= {(r.doc_id, r.license) for r in got}


def test_short_notices_of_any_hash(spark):
    """300 notices of five words, each at the beginning of a text of a full window."""
    rng = random.Random(6)
    notices = {f"T{i}": f"license a{rng.randrange(10**6)} b{i} c{rng.randrange(10**6)} d" for i in range(300)}
    docs = [(i, " ".join([t, *(f"q{rng.randrange(10**6)}" for _ in range(19))])) for i, t in enumerate(notices.values())]
    got = L.license_scan(spark.createDataFrame(docs, "doc_id long, text string").repartition(8), notices).collect()
    assert {(r.doc_id, r.license) for r in got} == {(i, f"T{i}") for i in range(300)}


def test_very_long_tokens_and_odd_rows(spark):
    docs = [(1, "x" * 200_000), (2, f"{'y' * 200_000} {L.TEMPLATES['MIT']}"), (None, L.TEMPLATES["MIT"]), (3, "!!! ???")]
    got = {(r.doc_id, r.license) for r in L.license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == {(2, "MIT")}


def test_whole_texts_with_changes(spark):
    """Of a license's whole text, a tenth of the words in one stretch may be others; half of it isn't the license."""
    text = L.words_of(L.TEMPLATES["MIT-text"])
    changed = [*text[:60], *(f"z{k}" for k in range(len(text) // 10)), *text[60 + len(text) // 10 :]]
    docs = [(1, " ".join(text)), (2, " ".join(changed)), (3, " ".join(text[: len(text) // 2]))]
    got = {(r.doc_id, r.license) for r in L.license_scan(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert {d for d, name in got if name == "MIT-text"} == {1, 2}
