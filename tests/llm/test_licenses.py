"""op9: planted notices, and every notice line of the driver's table."""

import random
import re

from contentflow.llm.licenses import TEMPLATES, Scanner, license_findings
from contentflow.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def found(text, **more):
    return sorted((f[0], f[1], f[4]) for f in Scanner(TEMPLATES, 0.9).scan(text, **more))


def test_every_template_is_found_as_itself():
    for name, text in TEMPLATES.items():
        for shown in (text, text.upper(), "\n".join("# " + x for x in re.findall(r".{1,60}(?:\s|$)", text))):
            assert found("prose before\n\n" + shown + "\n\nprose after")[0][1:] == (name, 0), name


def test_changed_and_wrong_wording():
    mit = TEMPLATES["MIT"].replace("free of charge", "free of cost")
    assert found(mit) == [(0, "MIT", 1)]
    assert found(" ".join(TEMPLATES["MIT"].split()[:40])) == []
    assert found("The licence of his boat had no warranty.\ncopyright law") == []
    assert found("") == []


def layouts(text):
    words = text.split()
    yield text
    yield "\n".join("# " + x for x in re.findall(r".{1,60}(?:\s|$)", text))
    yield "\n".join(" ".join(words[i:i + 3]) for i in range(0, len(words), 3))
    yield text.replace(". ", ".\n\n")
    yield "/*\n * " + "\n *\n * ".join(" ".join(words[i:i + 9]) for i in range(0, len(words), 9)) + "\n */"
    yield "x" * 300 + " " + text.upper() + " " + "y" * 300


def test_every_template_in_six_layouts():
    for name, text in TEMPLATES.items():
        for n, shown in enumerate(layouts(text)):
            assert [f[1:] for f in found(f"some prose before\n{shown}\nand after")] == [(name, 0)], (name, n)


def test_other_licenses_are_not_taken_for_known_ones():
    some = {k: v for k, v in TEMPLATES.items() if not k.startswith(("LGPL", "BSD-3", "CC-BY-ND", "CC-BY-NC", "CC-BY-SA", "AGPL"))}
    scanner = Scanner(some, 0.9)
    for name in ("LGPL-2.1-notice", "LGPL-3.0-notice", "AGPL-3.0-notice", "CC-BY-ND-4.0", "CC-BY-SA-4.0"):
        assert list(scanner.scan(TEMPLATES[name])) == [], name
    for text in ("This work is not licensed under a Creative Commons Attribution 4.0 International License.",
                 "It is not licensed under the Apache License, Version 2.0.", "It was never released under the MIT License.",
                 "This work is licensed under the GNU General Public License, version 2.", "Licensed under the Apache License, Version 1.1.",
                 "This work is licensed under the GNU Lesser General Public License, version 3."):
        assert found(text) == [], text


def test_rarest_words_are_in_every_notice():
    """Whatever words are missing, as many as may be, one of the rarest is left."""
    rng = random.Random(5)
    scanner = Scanner(TEMPLATES, 0.9)
    for name, want in scanner.words.items():
        for _ in range(200):
            left = sorted(rng.sample(range(len(want)), scanner.need[name]))
            assert {want[i] for i in left} & scanner.rare[name], name


def brute(scanner, text):
    """Licenses of a text: every template compared at every place of the whole text, the
    fewest differences first."""
    from contentflow.llm.licenses import words
    have, out = words(text), []
    while True:
        places = {}
        for i, w in enumerate(have):
            places.setdefault(w, []).append(i)
        hits = [(-same, len(v) + b - a - 2 * same, name, a, b) for name, v in scanner.words.items() for same, a, b in scanner.spans(name, have, places)
                if not scanner.refused(name, have, a, b)]
        if not hits:
            return sorted(out)
        gone = set()
        while hits:
            longest = min(hits)
            rivals = [h for h in hits if h[3] < longest[4] and longest[3] < h[4] and h[0] - longest[0] <= 3]
            _, _, name, a, b = min(rivals, key=lambda h: (h[1], h[0], h[2]))
            out.append(name)
            gone |= set(scanner.matched(name, have, a, b))
            hits = [h for h in hits if h[3] >= b or a >= h[4]]
        have = [w for i, w in enumerate(have) if i not in gone]


def test_texts_with_changed_notices_against_all_places():
    rng = random.Random(11)
    scanner = Scanner(TEMPLATES, 0.9)
    for _ in range(60):
        parts = []
        for name in rng.sample(sorted(TEMPLATES), rng.randint(1, 3)):
            w = TEMPLATES[name].split()
            if len(w) > 15:
                w[rng.randrange(len(w))] = rng.choice(["changed", "the", ""])
            parts += [prose(rng, rng.randint(5, 60)), " ".join(w)]
        text = "\n".join(parts)
        assert sorted(f[1] for f in scanner.scan(text)) == brute(scanner, text), text


def test_several_in_one_text():
    text = "\n".join([TEMPLATES["MIT-line"], TEMPLATES["Apache-2.0-line"], *["prose"] * 9, "", TEMPLATES["GPL-3.0-line"]])
    assert found(text) == [(0, "MIT-line", 0), (1, "Apache-2.0-line", 0), (12, "GPL-3.0-line", 0)]


def test_long_block():
    text = ("license " * 1500 + "\n") * 3 + TEMPLATES["MPL-2.0"]
    assert [f[1] for f in found(text)] == ["MPL-2.0"]


def prose(rng, n):
    return " ".join(rng.choices("the of any this program is work under to in software license version free copy and a sea".split(), k=n))


def test_exact_notices_in_one_long_line():
    rng = random.Random(6)
    for name, text in TEMPLATES.items():
        for before, after in ((300, 700), (1000, 1000), (5000, 3000)):
            hits = [f[1:] for f in found(f"{prose(rng, before)} {text} {prose(rng, after)}")]
            assert (name, 0) in hits, (name, before)


def test_changed_first_words_after_prose():
    rng = random.Random(9)
    for name, first in (("GPL-3.0-notice", "Foo is"), ("AGPL-3.0-notice", "Foo is"), ("GPL-2.0-notice", "Foo is"), ("MPL-2.0", "That")):
        text = " ".join([first, *TEMPLATES[name].split()[2:]])
        for before in (150, 400, 1500):
            hits = [f[1:] for f in found(f"{prose(rng, before)} {text} {prose(rng, 200)}")]
            assert name in [h[0] for h in hits] and all(h[1] <= 2 for h in hits if h[0] == name), (name, before)


def test_overlapping_notices_are_told_once():
    text = " ".join([TEMPLATES["MIT-line"], TEMPLATES["GPL-3.0-notice"], TEMPLATES["CC-BY-4.0"]] * 40)
    hits = [f[1] for f in found(text)]
    assert {k: hits.count(k) for k in set(hits)} == {"MIT-line": 40, "GPL-3.0-notice": 40, "CC-BY-4.0": 40}


def test_every_place_against_plain_dynamic_programming():
    rng = random.Random(7)
    scanner = Scanner({"x": "a b c d e f g h i j"}, 0.8)
    for _ in range(200):
        have = rng.choices("abcdefghijklm", k=rng.randrange(40))
        if rng.random() < 0.7:
            have[5:5] = [w for w in "abcdefghij" if rng.random() < 0.9]
        want = set()
        for a in range(len(have)):
            row = [0] * 11
            lengths = [0]
            for w in have[a:a + 20]:
                old = row[:]
                for i, x in enumerate("abcdefghij", 1):
                    row[i] = old[i - 1] + 1 if w == x else max(old[i], row[i - 1])
                lengths.append(row[10])
            if lengths[-1] >= 8 and have[a] in "abc":
                want.add((lengths[-1], a, a + lengths.index(lengths[-1])))
        places = {}
        for i, w in enumerate(have):
            places.setdefault(w, []).append(i)
        spans = set(scanner.spans("x", have, places))
        assert spans == want
        for same, a, b in spans:
            at = scanner.matched("x", have, a, b)
            got = [have[p] for p in sorted(at)]
            assert len(at) == same and got == sorted(got)


def test_whole_table(spark):
    lines = {TEMPLATES[k]: k for k in ("MIT-line", "Apache-2.0-line", "GPL-3.0-line", "CC-BY-NC-4.0-line")}
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    want = {(d, lines[x]) for d, t in docs for x in t.split("\n") if x in lines}
    assert len(want) > 5
    assert {(r["doc_id"], r["license"]) for r in QUERIES["op9_licenses"](spark, SF).collect()} == want


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, TEMPLATES["MIT-line"]), (3, TEMPLATES["ISC"]), (3, TEMPLATES["ISC"])]
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, license string")
    assert sorted((str(r["doc_id"]), r["license"]) for r in license_findings(df).collect()) == [("3", "ISC"), ("3", "ISC"), ("None", "MIT-line")]
    assert license_findings(df.limit(0)).collect() == []
