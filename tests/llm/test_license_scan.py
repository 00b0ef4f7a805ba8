import random

from sitewright.llm.license_scan import index, matches, scan
from sitewright.llm.queries import LICENSES, QUERIES

GROUPS = index(LICENSES)


def brute(texts, threshold=0.8):
    return sorted(matches([(t or "").encode() for t in texts], GROUPS, threshold, retrieve=False))


def test_edited_copies_are_found():
    rng = random.Random(5)
    filler = [f"word{i}" for i in range(500)]
    texts, want = [], []
    for k in range(300):
        name, text = LICENSES[k % len(LICENSES)]
        w = text.split()
        for _ in range(len(w) // 60):  # an edit breaks five shingles
            w[rng.randrange(len(w))] = "edited"
        pad = [rng.choice(filler) for _ in range(rng.randint(0, 300))]
        cut = rng.randint(0, len(pad))
        texts.append(" ".join(pad[:cut] + w + pad[cut:]))
        want.append(name)
    raw = [t.encode() for t in texts]
    got = sorted(matches(raw, GROUPS, 0.8))
    exact = brute(texts)
    assert len(set(exact) - set(got)) <= 1 and not {g[:2] for g in got} - {e[:2] for e in exact}
    kept = {(i, n) for i, n, *_ in exact}
    assert sum((i, n) in kept for i, n in enumerate(want)) >= 295


def test_equals_all_windows_on_whole_table(spark, sf):
    rows = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id").collect()
    want = {}
    for i, name, lo, hi, c in brute([r.text for r in rows]):
        n, first, best = want.get((rows[i].doc_id, name), (0, lo, c))
        want[rows[i].doc_id, name] = (n + 1, min(first, lo), max(best, c))
    got = {(r.doc_id, r.license): (r.n_places, r.first_word, r.containment) for r in QUERIES["op10_license_scan"](spark, sf).collect()}
    assert got == want and got
    notice = {r.doc_id for r in rows if "Released under the MIT License." in (r.text or "")}
    assert notice <= {i for i, n in got if n == "mit-notice"}


def test_odd_rows(spark):
    texts = [None, "", " \n", "mit", "RELEASED under the mit LICENSE", "x " * 40000 + "Released under the MIT License.", "all rights", "all\nrights, reserved!",
             "Released under the MIT License. a b c d e f Released under the MIT License."]
    df = spark.createDataFrame([(i or None, t, "x", 1) for i, t in enumerate(texts)], "doc_id long, text string, template string, first_word int")
    got = sorted((r.doc_id, r.template, r.first_word, r.last_word, r.containment) for r in scan(df, LICENSES).collect())
    assert got == [(4, "mit-notice", 0, 4, 1.0), (5, "mit-notice", 40000, 40004, 1.0), (7, "all-rights-reserved", 0, 2, 1.0),
                   (8, "mit-notice", 0, 4, 1.0), (8, "mit-notice", 11, 15, 1.0)]
    assert scan(df.limit(0), LICENSES).collect() == [] and scan(df, []).collect() == [] and scan(df, [("none", "  ")]).collect() == []


def test_public_licenses_are_known(spark):
    names = [n for n, _ in LICENSES]
    assert len(set(names)) == len(names)
    texts = {n: t for n, t in LICENSES if n.endswith("-text")}
    assert {"gpl-3-text", "lgpl-2.1-text", "mpl-2.0-text", "isc-text", "bsd-3-clause-text", "cc0-1.0-text", "unlicense-text"} <= set(texts)
    want = {**texts, "agpl-3.0-header": dict(LICENSES)["agpl-3.0-header"], "mit-notice-licensed": "This is licensed under the MIT license, as is"}
    df = spark.createDataFrame([(n, "before it " * 9 + t + " after it" * 9) for n, t in want.items()], "doc_id string, text string")
    assert {(n, n) for n in want} <= {(r.doc_id, r.template) for r in scan(df, LICENSES).collect()}
