import math
import random
import re
import textwrap

import numpy as np
from pyspark.sql import functions as F

from jobweave.llm import licenses


def grams(text):
    w = [x for x in re.split("[^a-z0-9]+", text.lower()) if x]
    return set(w) | {f"{a} {b}" for a, b in zip(w, w[1:])}


def test_no_confirmed_paragraph_is_left_out():
    """Any share of a template's features that confirms holds one of its key n-grams, and so a key word."""
    rng = random.Random(1)
    words = set(licenses.key_words())
    for texts in licenses.TEMPLATES.values():
        for text in texts:
            all_grams, keys = sorted(grams(text)), set(licenses.key_grams(text))
            assert keys <= set(all_grams)
            least = math.ceil(licenses.LEAST_SIMILARITY * len(all_grams) - 1e-9)
            assert len(all_grams) - len(keys) < least  # the others do not suffice
            for _ in range(50):
                chosen = rng.sample(all_grams, least)
                assert {w for g in chosen for w in g.split()} & words


def wrapped(text, width):
    return "\n".join(textwrap.wrap(text, width))


def test_every_template_bare_embedded_and_wrapped(spark):
    prose = "The dog went over the hill and met another dog in the valley below."
    rows, want = [], {}
    for family, texts in licenses.TEMPLATES.items():
        for text in texts:
            for made in (text, f"{prose}\n{text}\n{prose}", f"{prose} {text} {prose}", wrapped(text, 80), f"{prose}\n\n{wrapped(text, 60)}\n\n{prose}", f"{prose}\n{wrapped(text, 80)}\n{prose}"):
                want[len(rows)] = (family, made)
                rows.append((len(rows), made))
    docs = spark.createDataFrame(rows + [(9000 + i, f"{prose} {i}\nSee the other {i} public houses.") for i in range(60)], "doc_id long, text string")
    found = {}
    for r in licenses.scan(docs).where("confirmed").collect():
        found.setdefault(r.doc_id, set()).add(r.family)
    missed = [want[i] for i in want if want[i][0] not in found.get(i, ())]
    assert not missed, missed
    assert not {i for i in found if i >= 9000}


def test_short_notices_as_they_are_met(spark):
    met = {
        "Text is available under CC BY-SA 4.0.": "cc-by-sa",
        "Content available under CC BY 4.0.": "cc-by",
        "Copyright 2024 Somebody. All rights reserved.": "proprietary",
        "All rights reserved.": "proprietary",
        "This code is released under the MIT license": "mit",
    }
    docs = spark.createDataFrame([(i, f"Some words before.\n{t}\nSome words after.") for i, t in enumerate(met)], "doc_id long, text string")
    found = {r.doc_id: r.family for r in licenses.scan(docs).where("confirmed").collect()}
    assert found == dict(enumerate(met.values()))


def test_all_planted_lines(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    planted = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("paragraph", "line")).where(F.col("line").rlike("(?i)licensed under|released under|rights reserved"))
    found = licenses.scan(docs).where("confirmed").select("doc_id", "paragraph", "n_lines")
    assert planted.count() == 46 and planted.join(found, ["doc_id", "paragraph"], "left_anti").count() == 0
    assert found.count() == 46


def test_features_are_those_by_hand(spark):
    texts = ["", "one", "Licensed under CC BY-NC 4.0.", "a a a b", "é 1"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    got = [set(r[0]) for r in df.select(licenses.features(df.text)).collect()]
    assert got == [grams(t) for t in texts]


def test_scan(spark):
    prose = [f"The {w} went over the hill and met {w} again in the valley below." for w in "dog cat cow fox owl hen".split()]
    lines = {
        0: ("Licensed under the Apache License, Version 2.0.", "apache-2.0"),
        1: ("Released under the MIT License.", "mit"),
        2: ("This work is licensed under the GNU General Public License, version 3.", "gpl-3.0"),
        3: ("Licensed under CC BY-NC 4.0.", "cc-by-nc"),
        4: ("Licensed under CC BY 4.0.", "cc-by"),
        5: ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.", "mit"),
        6: ("A fishing licence can be bought at the harbour.", None),
        7: ("She gave permission to redistribute the bread among the guests.", None),
    }
    rows = [(i, "\n".join([prose[i % 6], line, prose[(i + 1) % 6]])) for i, (line, _) in lines.items()]
    rows += [(20, None), (21, ""), (22, lines[1][0] + "\n" + lines[1][0]), (None, lines[0][0]), (0, rows[0][1]), (23, "\n".join(prose * 2000 + [lines[3][0]]))]
    docs = spark.createDataFrame([(*r, "x", 1.0) for r in rows], "doc_id long, text string, family string, probability double")
    found = licenses.scan(docs).collect()
    sure = sorted(((r.doc_id, r.paragraph, r.family) for r in found if r.confirmed), key=str)
    want = [(i, 1, family) for i, (_, family) in lines.items() if family]
    want += [(22, 0, "mit"), (22, 1, "mit"), (None, 0, "apache-2.0"), (0, 1, "apache-2.0"), (23, 12_000, "cc-by-nc")]
    assert sure == sorted(want, key=str)
    assert all(0.5 <= r.probability <= 1 for r in found)
    # Similarities are shares of the template's features.
    for r in found:
        if r.doc_id in lines:
            family, number = r.template.split("/")
            template = grams(licenses.TEMPLATES[family][int(number)])
            assert abs(r.similarity - len(template & grams(lines[r.doc_id][0])) / len(template)) < 1e-9

    # Probabilities by hand from the weights.
    weights, classes, intercepts, temperature = licenses.train(docs)
    table = {r.gram: np.array(r.w) for r in weights.collect()}
    for r in found:
        if r.doc_id in lines:
            z = np.array([intercepts[c] for c in classes]) + sum(table[g] for g in grams(lines[r.doc_id][0]) if g in table)
            p = np.exp((z - z.max()) / temperature)
            assert classes[int(p.argmax())] == r.family and abs(p.max() / p.sum() - r.probability) < 1e-9
    text = licenses.scan(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "Arrow" not in text and "NestedLoop" not in text


def test_empty_table(spark):
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).collect() == []
