"""Licence scan: words and base phrases against a plain search, templates, and a plan without Python."""

from __future__ import annotations

import itertools
import re

import duckdb

from tests.compare import compare
from tickbars.llm import licences, queries_licences

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LABELS = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}


def plain(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(low)
    starts, labels = [], set()
    for phrase, label in LABELS.items():
        parts = phrase.split()
        found = [i for i in range(len(words)) if words[i : i + len(parts)] == parts]
        starts += found
        labels |= {label} if found else set()
    return len(words), len(starts), min(starts, default=None), max(starts, default=None), ",".join(sorted(labels))


def scanned(frame):
    return {r.doc_id: r for r in licences.scan_licences(frame).collect()}


FILLER = " ".join(f"word{i}" for i in range(50))
MIT = licences.TEMPLATES[9][1]
TEXTS = [
    None, "", "MIT License", "mit-license MIT\nLICENSE, é mit licensé İ mit LİCENSE", "Kelvin Kmit license K",
    f"{FILLER}. {MIT.upper()} {FILLER}", f"{FILLER} Licensed under the Apache License, Version 2.0. {FILLER}",
    "This work is licensed under the GNU General Public License, version 3.", "permission granted to deal in free software of charge",
    "general public licensee", "a mit license apache license b " * 300, "Released under the MIT License. " * 3, MIT[:70],
    "x" * 200_000, "the of and to " * 20_000,
]


def test_base_and_templates(spark, docs_of):
    got = scanned(docs_of(TEXTS).selectExpr("*", "1 AS n_words", "2 AS words", "3 AS index"))
    for i, text in enumerate(TEXTS):
        r = got[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain(text), i
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
    assert got[5].labels == "mit-text" and got[5].found[0].start == 50 and got[5].score == 1
    assert got[6].labels == "apache,apache-2.0-notice" and got[7].labels == "gpl,gpl-3.0-notice"
    assert got[11].labels == "mit,mit-notice" and [f.start for f in got[11].found] == [0, 5, 10]
    assert got[8].labels == "" and got[12].labels == "" and got[0].score == 0 and got[2].score == 0.5


def test_every_template_is_found(spark, docs_of):
    got = scanned(docs_of([f"{FILLER}\n{text}\n{FILLER}" for _, text, _ in licences.TEMPLATES]))
    for i, (name, _, _) in enumerate(licences.TEMPLATES):
        assert name in got[i].labels.split(","), name


def test_files_with_several_licences(spark, docs_of):
    """Two to five whole templates in one file, in a corpus that makes their words differ in rarity."""
    every = licences.TEMPLATES
    sets = [list(c) for n, step in ((2, 1), (3, 5), (4, 11), (5, 17)) for c in list(itertools.combinations(every, n))[::step]]
    texts = ["\n".join(f"{FILLER}\n{text}" for _, text, _ in own) for own in sets]
    stray = " ".join(sorted({w for _, text, _ in every for w in text.split()}, reverse=True))
    texts += [f"{FILLER} {text}\n{stray}" for _, text, _ in every]
    sets += [[x] for x in every]
    got = scanned(docs_of([*texts, *(text for k, (_, text, _) in enumerate(every) for _ in range(k))]))
    for i, own in enumerate(sets):
        assert {name for name, _, _ in own} <= set(got[i].labels.split(",")), i
        starts = {f.template: f.start for f in got[i].found}
        assert all(starts[name] == 50 + sum(50 + len(t.split()) for _, t, _ in own[:k]) for k, (name, _, _) in enumerate(own) if not name.endswith("notice"))


def test_repeated_rows_and_empty_table(spark, docs_of):
    frame = docs_of([(1, "mit license"), (1, "mit license"), (None, "a")])
    assert sorted((r.doc_id or 0, r.n_base) for r in licences.scan_licences(frame).collect()) == [(0, 0), (1, 1), (1, 1)]
    assert licences.scan_licences(frame.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, sf_dir):
    plan = queries_licences.op3_license_scan(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow|CartesianProduct|NestedLoop", plan)


def test_sql_agrees_on_files_with_several_licences(spark, docs_of, table_dir):
    """All single templates, pairs and triples, and one file that holds every template many times."""
    texts = ["\n".join(f"{FILLER}\n{text}" for _, text, _ in c) for n in (1, 2, 3) for c in itertools.combinations(licences.TEMPLATES, n)]
    assert len(texts) == 231
    texts.append("\n".join(text for _, text, _ in licences.TEMPLATES) * 20)
    folder = table_dir(documents=docs_of([*texts, *TEXTS]))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/documents.parquet/*.parquet'")
    assert compare(spark, con, folder, queries_licences.op3_license_scan, queries_licences.OP3_SQL) == []


def test_many_licences_in_one_file(spark, docs_of):
    """Work grows with the words: every place of 800 repeats of all templates is found."""
    whole = "\n".join(f"{FILLER}\n{text}" for _, text, _ in licences.TEMPLATES)
    got = scanned(docs_of([(1, whole), (2, "\n".join([whole] * 800))]))
    assert len(got[2].found) == 800 * len(got[1].found) and got[2].labels == got[1].labels
