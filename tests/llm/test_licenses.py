"""License scans against a search of every place, and against the SQL."""

import re
from collections import Counter

import duckdb
import pytest

from tidemark.llm import licenses
from tidemark.llm.licenses import RARE, TEMPLATES, Template, license_labels, license_sql, scan_licenses

MIT = "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files"
TEXTS = [
    (1, f"{MIT} and so on. All rights\nreserved."),
    (1, f"{MIT} and so on. All rights\nreserved."),  # a repeated row
    (2, "Licensed under CC BY-NC 4.0. Licensed under cc by, and CC-BY; cc_by"),
    (3, None),
    (4, ""),
    (5, "all rights all rights reserved rights reserved"),
    (6, "mit MIT Mit license the mit mit license released under a mit license"),
    (None, "Released under the MIT License"),
    (7, "x " * 5000 + "GNU General Public License, version 3 " * 300 + "general public license"),
    (8, "redistribution and use of source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    (9, "Redistribution and use in source and binary forms, with or without any modification at all"),
    (10, "Redistribution and use in source and binary forms, with or without alteration, are allowed provided that the following conditions are met"),
    (11, "ALL RIGHTS RESERVED all rights reservedé K all\x7frights\x00reserved"),
    (12, "General Public"),
    (13, "license version 3 of the general public"),
]
MORE = "doc_id long, text string, words array<string>, hits int, codes int, places int, label string"


@pytest.fixture(scope="module")
def docs(spark):
    """Columns that clash with names inside the operator stand beside the texts."""
    return spark.createDataFrame([(i, t, ["w"], 1, 2, 3, "x") for i, t in TEXTS], MORE).repartition(3)


def words(text):
    return re.findall("[0-9a-z\x80-\U0010ffff]+", "".join(c.lower() if c.isascii() else c for c in text or ""))


def truth(texts, templates):
    """Every template at every place of every text."""
    split = [(key, words(text)) for key, text in texts]
    often = Counter(w for _, ws in split for w in set(ws))
    for key, ws in split:
        bases, labels, score = [], set(), 0.0
        for t in templates:
            parts = words(t.text)
            order = sorted(range(len(parts)), key=lambda i: (often[parts[i]], parts[i], i))
            rare = order[: 1 if t.base else min(RARE, len(parts))]
            sought = [p.split() for p in t.phrases]
            must = {next(i for i in range(len(parts)) if parts[i : i + len(p)] == p): p for p in sought}
            for start in range(-len(parts), len(ws)):
                same = [0 <= start + i < len(ws) and ws[start + i] == parts[i] for i in range(len(parts))]
                if 3 * sum(same[i] for i in rare) < 2 * len(rare) or not all(all(same[i : i + len(p)]) for i, p in must.items()):
                    continue
                labels.add(t.label)
                score = max(score, sum(same) / len(same))
                if t.base:
                    bases.append((start, t.label))
        starts = [s for s, _ in bases] or [None]
        yield key, len(ws), len(bases), min(starts), max(starts), ",".join(sorted({x for _, x in bases})), ",".join(sorted(labels)), score


def test_against_every_place(docs, rows):
    assert rows(license_labels(docs)) == sorted(truth(TEXTS, TEMPLATES), key=repr)


def test_base_phrases_are_exact(docs):
    """The counts by a plain search of the joined words."""
    phrases = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
    got = {r.doc_id: r for r in license_labels(docs).collect()}
    for key, text in TEXTS:
        joined = " " + " ".join(words(text)) + " "
        found = {p: len(re.findall(f"(?= {p} )", joined)) for p in phrases}
        assert got[key].n_base == sum(found.values())
        assert got[key].base_labels == ",".join(sorted(phrases[p] for p, n in found.items() if n))


def test_against_sql(docs, rows):
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", TEXTS)
    assert rows(license_labels(docs)) == sorted(con.execute(license_sql()).fetchall(), key=repr)


def test_one_phrase_may_not_differ(docs, rows):
    found = {r.doc_id: {p.label for p in r.places} for r in scan_licenses(docs).collect()}
    assert "bsd" in found[10] and "bsd" not in found[8] | found[9]
    with pytest.raises(ValueError, match="no 'b' in the template"):
        Template("x", "a c", ("b",)).mandatory  # noqa: B018


def test_nothing_and_no_python_workers(docs):
    assert license_labels(docs.limit(0)).isEmpty()
    plan = license_labels(docs)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Exchange hash" not in plan
    assert max(len(t.words) for t in TEMPLATES) < licenses.MARGIN
