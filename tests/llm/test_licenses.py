import random
import re

import pyarrow as pa

from asiento.llm import licenses as L


def tokens(text):
    return re.findall(r"[a-z0-9\x80-\U0010ffff]+", text.lower())


def slow(text, templates, k=5, share=0.8):
    """Templates of whose shingles a window of twice their length holds the share."""
    t, found = tokens(text), set()
    for name, template in templates.items():
        w = tokens(template)
        own = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)}
        level = 1 << (len(w) - k).bit_length()
        shingles = [tuple(t[i : i + k]) for i in range(len(t) - k + 1)]
        if own and any(len(own & set(shingles[i : i + level + 1])) >= share * len(own) for i in range(len(shingles))):
            found.add(name)
    return found


def test_against_brute_force():
    rng, names = random.Random(1), list(L.TEMPLATES)
    texts = []
    for _ in range(400):
        words = [f"w{rng.randrange(900)}" for _ in range(rng.randrange(120))]
        copy = L.TEMPLATES[rng.choice(names)].split()
        if rng.random() < 0.3:
            copy[rng.randrange(len(copy))] = "changed"
        texts.append(" ".join(words[: len(words) // 2] + (copy if rng.random() < 0.7 else []) + words[len(words) // 2 :]))
    built = L.build_templates(L.TEMPLATES)
    found = [{x["license"] for x in row} for row in L.licenses_of(pa.array(texts), built, 0.8, L.BANDS)]
    wanted = [slow(t, L.TEMPLATES) for t in texts]
    assert sum(map(len, wanted)) > 150
    missed = sum(len(w - f) for w, f in zip(wanted, found, strict=True))
    assert missed <= 0.01 * sum(map(len, wanted))
    # A window may be up to twice the template's length, so it can hold a little more than the brute force looks at.
    assert all(f - w == set() or f & w for f, w in zip(found, wanted, strict=True))


def test_table(spark):
    mit = L.TEMPLATES["MIT"]
    rows = [(1, mit, "x"), (1, mit, "x"), (None, mit.upper(), None), (3, None, "x"), (4, "", "x"), (5, "word " * 100_000 + mit, "x"), (6, "Released under the", "x"), (7, "MIT License.", "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, licenses string")
    out = L.scan_licenses(docs)
    assert out.columns == [*docs.columns, "licenses_2"]
    got = sorted((r.doc_id or 0, [(x.license, x.containment, x.first_word) for x in r.licenses_2]) for r in out.collect())
    assert got == [(0, [("MIT", 1.0, 0)]), (1, [("MIT", 1.0, 0)]), (1, [("MIT", 1.0, 0)]), (3, []), (4, []), (5, [("MIT", 1.0, 100_000)]), (6, []), (7, [])]
    assert L.scan_licenses(docs.limit(0)).collect() == []
    own = L.scan_licenses(docs, {"mine": "word word word word word word", "short": "one two", "none": ""})
    assert [r.doc_id for r in own.collect() if r.licenses_2] == [5]
