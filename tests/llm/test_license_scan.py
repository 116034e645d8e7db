"""Licence scans against a plain search."""

import random
import re

import numpy as np

from feedback_loom.llm import license_scan, queries

BASE = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def by_hand(text):
    words = re.findall(rb"[0-9a-z\x80-\xff]+", (text or "").encode().lower())
    places, labels = [], set()
    for phrase, label in BASE.items():
        wanted = phrase.encode().split()
        for i in range(len(words) - len(wanted) + 1):
            if words[i:i + len(wanted)] == wanted:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


def test_whole_table_equals_plain_search(spark, folder):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    for r in queries.op9_license_scans(spark, folder).collect():
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == by_hand(docs[r.doc_id])
        assert set(r.base_labels.split(",")) <= {*r.labels.split(","), ""} and 0 <= r.score <= 1


def test_phrases_templates_and_edges(spark):
    texts = ["The MIT-License, or mit  license!", "mit\nlicense apache license general public license apache license", "mit licenses", "mit", None, "",
             "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation "
             "files, to deal in the software without restriction", "permission is hereby granted free of charge, or not",
             "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following "
             "conditions are met:", "general public", "license", "x" * 100_000 + " mit license", "ＭIT license é mit license"]
    docs = spark.createDataFrame([(i // 2, t, "q") for i, t in enumerate(texts)], "doc_id long, text string, labels string")
    got = license_scan.scanned(docs.coalesce(1)).collect()
    assert [(r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in got] == [by_hand(t) for t in texts]
    assert got[6].labels == "mit" and got[6].base_labels == "" and got[6].score == 1.0
    assert got[7].labels == "" and 0 < got[7].score < 0.6 and got[8].labels == "bsd" and got[4].score == 0
    assert license_scan.scanned(docs.limit(0)).collect() == []


def test_phrases_do_not_cross_texts(spark):
    docs = spark.createDataFrame([(1, "the mit"), (2, "license of")], "doc_id long, text string").coalesce(1)
    assert [r.n_base for r in license_scan.scanned(docs).collect()] == [0, 0]


def test_many_templates_equal_plain_search(spark):
    rng = random.Random(5)
    words = [f"w{i}" for i in range(60)]
    phrases = sorted({" ".join(rng.choices(words, k=rng.randint(1, 4))) for _ in range(750)})
    templates = tuple(license_scan.Template(f"t{i:03}", p, f"lead {p} tail", True) for i, p in enumerate(phrases))
    assert len(templates) >= 500
    texts = [" ".join(rng.choices(words + ["other"], k=rng.randint(0, 300))) for _ in range(40)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(2)
    for r in license_scan.scanned(docs, templates=templates).collect():
        text = texts[r.doc_id].split()
        wanted = {(t, i) for t, p in enumerate(phrases) for i in range(len(text)) if text[i:i + len(p.split())] == p.split()}
        assert {(x.template, x.first_word) for x in r.places} == wanted and r.n_base == len(wanted) == len(r.places)


def test_lookups_follow_hits_not_templates():
    """A common word of all key phrases has no postings as long as rarer words stand beside it."""
    templates = tuple(license_scan.Template(f"t{i}", f"common a{i} b{i}", f"common a{i} b{i}") for i in range(500))
    index = license_scan.PositionalIndex(templates, {"common": 1000} | {f"{x}{i}": 1 for x in "ab" for i in range(500)})
    number = {w: i for i, w in enumerate(index.words)}
    numbers = np.array([number[w] for w in ["common"] * 1000 + ["common", "a7", "b7"]])
    at = np.arange(len(numbers))
    assert [len(index.looked_up(numbers, at, rank)) for rank in range(license_scan.RARE)] == [1, 1]
    template, start = index.places(numbers, np.zeros(len(numbers), np.int64))
    assert template.tolist() == [7] and start.tolist() == [1000]
