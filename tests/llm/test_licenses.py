"""Licence scans against plain Python."""

import math
import re
from collections import Counter

from tamiz.llm import licenses


def tokens(text):
    return re.findall("[a-z0-9]+", text.translate(str.maketrans(licenses.UPPER, licenses.LOWER)))


def brute(rows, least=0.8):
    """All units of all files, scored one by one from the texts of the templates."""
    lined = [(p, [x for x in map(tokens, t.split("\n")) if x] if t is not None else []) for p, t in rows]
    n_lines = sum(len(x) for _, x in lined)
    short = [(name, Counter(tokens(t))) for name, t in licenses.TEMPLATES]
    long = [(name, Counter(tokens(t))) for name, t in licenses.TEXTS]
    held = Counter(t for _, x in lined for line in x for t in set(line))
    vocabulary = {t for _, c in short + long for t in c}

    def idf(t):
        return math.log((1 + n_lines) / (1 + (held[t] if t in vocabulary else 0))) + 1

    own = {}
    for p, x in lined:
        units = [(x[i : i + n], short) for i in range(len(x)) for n in (1, 2, 3) if i + n <= len(x)]
        units += [(x[i : i + n], long) for i in range(6) for n in (5, 8, 12, 16, 22, 32) if i < len(x)]
        if p is not None and re.match(licenses.LICENCE_FILE, p.split("/")[-1]):
            units.append((x, long))
        for unit, templates in units:
            c = Counter(t for line in unit for t in line)
            norm = math.sqrt(sum((n * idf(t)) ** 2 for t, n in c.items()))
            for name, y in templates:
                tn = math.sqrt(sum((n * idf(t)) ** 2 for t, n in y.items()))
                s = round(sum(c[t] * n * idf(t) ** 2 for t, n in y.items()) / norm / tn, 6) if norm else 0
                if s >= least:
                    own[p] = min(own.get(p, (1, "")), (-s, name))
    place = {}
    for p, b in own.items():
        if p is not None and re.match(licenses.LICENCE_FILE, p.split("/")[-1]):
            d = p.rpartition("/")[0]
            place[d] = min(place.get(d, (1, "")), b)
    out = []
    for p, _ in rows:
        if p in own:
            out.append((p, own[p][1], -own[p][0], "own", None))
            continue
        d = p
        while d:
            d = d.rpartition("/")[0]
            if d in place:
                break
        found = p is not None and d in place
        out.append((p, place[d][1], None, "directory", d) if found else (p, None, None, "none", None))
    return sorted(out, key=repr)


ROWS = [
    ("a/LICENSE", "Some words\nReleased under the MIT License.\nmore"), ("a/b/c/x.txt", "nothing of note"), ("a/b/y.txt", "All rights reserved."),
    ("a/b/COPYING", "licensed under the APACHE license, version 2.0"), ("a/b/c/d/z.txt", None), ("other/LICENSE.md", "plain words only"),
    ("other/q.txt", ""), ("top.txt", "This work is licensed under the GNU General Public License, version 3."), ("LICENCE", "Licensed under CC BY-NC 4.0."),
    ("solo.txt", "the of and"), (None, "Released under the MIT License."), (None, "x"), ("a/b/y.txt", "All rights reserved."),
    ("deep/1/2/3/4/5/f", "word " * 50_000 + "license"), ("mix/f", "Released under the MIT License and a lot of other prose that lowers the cosine well below"),
    ("a/tie", "Licensed under CC BY 4.0."), ("\n/odd", "\n\n"),
]


TEXT = dict(licenses.TEXTS)


def wrapped(text, width, lead=""):
    """The text as lines of about so many words."""
    words = text.split()
    return "\n".join(lead + " ".join(words[i : i + width]) for i in range(0, len(words), width))


MIT = "MIT License\n\nCopyright (c) 2020 X Y\n\n" + wrapped(TEXT["MIT"], 13)
REAL = [
    ("mit/LICENSE", MIT), ("mit/src/a.py", "import os\n"), ("mit/src/deep/b.py", ""),
    ("bsd/COPYING", "Copyright 2019, The Authors\n" + wrapped(TEXT["BSD-3-Clause"], 12)), ("bsd/x.c", "int x;"),
    ("bsd/two/LICENSE.txt", wrapped(TEXT["BSD-2-Clause"], 12)), ("bsd/two/y.c", "int y;"),
    ("apache/LICENSE", "  Apache License\n Version 2.0, January 2004\n http://www.apache.org/licenses/\n\n TERMS AND CONDITIONS\n" + wrapped("other terms " * 400, 10)),
    ("apache/f.go", "package f"),
    ("gpl/COPYING", "GNU GENERAL PUBLIC LICENSE\nVersion 3, 29 June 2007\n\n" + wrapped("preamble words of it " * 300, 9)), ("gpl/g.c", "main"),
    ("head/a.py", "#!/usr/bin/env python\n# Copyright 2020 X Y. All rights reserved.\n#\n" + wrapped(TEXT["Apache-2.0"], 12, "# ") + "\n\nimport os\n" + "x = 1\n" * 30),
    ("head/b.c", "/*\n * Licensed under the Apache License,\n * Version 2.0.\n */\nint main;\n"),
    ("head/c.c", "/* " + wrapped(TEXT["GPL-3.0"], 11) + " */\nint main;\n" + "int y;\n" * 50),
    ("head/d.txt", "a file that grants use of the software and any copy of it with no license\n" * 20), ("isc/LICENSE", wrapped(TEXT["ISC"], 10)),
]
FOUND = {
    "mit/LICENSE": "MIT", "mit/src/a.py": "MIT", "mit/src/deep/b.py": "MIT", "bsd/COPYING": "BSD-3-Clause", "bsd/x.c": "BSD-3-Clause",
    "bsd/two/LICENSE.txt": "BSD-2-Clause", "bsd/two/y.c": "BSD-2-Clause", "apache/LICENSE": "Apache-2.0", "apache/f.go": "Apache-2.0",
    "gpl/COPYING": "GPL-3.0", "gpl/g.c": "GPL-3.0", "head/a.py": "Apache-2.0", "head/b.c": "Apache-2.0", "head/c.c": "GPL-3.0",
    "head/d.txt": None, "isc/LICENSE": "ISC",
}


def test_against_plain_python(spark):
    files = spark.createDataFrame([(p, t, "c") for p, t in ROWS], "path string, text string, license string")
    assert sorted(map(tuple, licenses.scan(files).collect()), key=repr) == brute(ROWS)
    assert licenses.scan(files.limit(0)).count() == 0


def test_headers_and_licence_files(spark):
    got = licenses.scan(spark.createDataFrame(REAL, "path string, text string"))
    rows = sorted(map(tuple, got.collect()), key=repr)
    assert {r[0]: r[1] for r in rows} == FOUND
    assert rows == brute(REAL)


def test_units_left_out_cannot_reach_the_threshold():
    terms = licenses.template_terms([*licenses.TEMPLATES, *licenses.TEXTS])
    vocabulary = sorted({t for _, c in terms for t in c})
    idf, _ = licenses.weights(vocabulary, 1000, {"license": 400, "the": 900, "under": 500, "of": 800})
    some = set(licenses.needed(terms, idf, 0.8))
    for _, x in terms:
        weight = {t: (n * idf[t]) ** 2 for t, n in x.items()}
        norm = sum(weight.values())
        # the best unit without a needed term, and the best one with too few terms
        assert math.sqrt(sum(w for t, w in weight.items() if t not in some) / norm) < 0.8
        few = licenses.fewest(x, idf, 0.8)
        assert math.sqrt(sum(sorted(weight.values())[::-1][: few - 1]) / norm) < 0.8
        assert math.sqrt(sum(sorted(weight.values())[::-1][:few]) / norm) >= 0.8 - 1e-9


PROSE = (
    "the of and to or in is this for with that be by as any not are on without you it under if from at may see an all so no do above use general "
    "have will even but hope can your program published later either version option terms"
).split()


def test_prose_of_common_words_is_no_candidate(spark):
    terms = licenses.template_terms(licenses.TEXTS)
    idf, _ = licenses.weights(sorted({t for _, c in terms for t in c}), 1000, dict.fromkeys(PROSE, 700))
    held = max(len(set(PROSE) & set(c)) - licenses.fewest(c, idf, 0.8) for _, c in terms)
    assert held >= 0  # as many terms as a template needs, but light ones
    for _, c in terms:
        share = sum(s for s, t in licenses._shares(c, idf) if t in PROSE)
        assert share < licenses.share_needed(0.8)
    files = spark.createDataFrame([(f"p/{i}", [PROSE, ["other", "words"]] * 20) for i in range(5)], "path string, lines array<array<string>>")
    assert licenses._texts(files, terms, idf, 0.8).count() == 0


def test_tokens_are_not_stored(spark, monkeypatch):
    stored = []

    def spy(df, name="step"):
        stored.append(df.columns)
        return materialize(df, name)

    materialize = licenses.materialize
    monkeypatch.setattr(licenses, "materialize", spy)
    got = licenses.scan(spark.createDataFrame(REAL, "path string, text string"))
    assert sorted(map(tuple, got.collect()), key=repr) == brute(REAL)
    assert stored and not any("tokens" in columns for columns in stored)
