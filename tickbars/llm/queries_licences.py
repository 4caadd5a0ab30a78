"""The licence scan query and its SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickbars.llm import licences


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return licences.scan_licences(docs).drop("found")


def _values(rows: list[tuple]) -> str:
    return ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in row) + ")" for row in rows)


def _sql(scan: licences.Scan = licences.Scan()) -> str:
    places = [(k, name, at, w) for k, (name, text, _) in enumerate(licences.TEMPLATES) for at, w in enumerate(text.split())]
    phrases = []
    for k, (_, text, needed) in enumerate(licences.TEMPLATES):
        own = text.split()
        for phrase in needed:
            n = len(phrase.split())
            phrases.append((k, next(i for i in range(len(own)) if own[i : i + n] == phrase.split()), n, phrase))
    base = [(phrase, len(phrase.split()), label) for phrase, label in licences.BASE]
    return rf"""
WITH d AS (
    SELECT row_number() OVER () AS row, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
    FROM documents
), w AS (SELECT row, i - 1 AS place, words[i] AS word FROM d, unnest(range(1, len(words) + 1)) AS t(i)),
templates(template, name, pos, word) AS (VALUES {_values(places)}),
phrases(template, pos, n, phrase) AS (VALUES {_values(phrases)}),
base(phrase, n, label) AS (VALUES {_values(base)}),
counts AS (SELECT word, count(DISTINCT row) AS n FROM w WHERE word IN (SELECT word FROM templates) GROUP BY word),
ranked AS (
    SELECT template, name, pos, word, coalesce(n, 0) AS n, row_number() OVER (PARTITION BY template ORDER BY coalesce(n, 0), pos) AS k
    FROM templates LEFT JOIN counts USING (word)
), entries AS (SELECT *, count(*) OVER (PARTITION BY template) AS size FROM ranked WHERE k <= {scan.places}),
held AS (SELECT DISTINCT row, word FROM w JOIN entries USING (word)),
voting AS (SELECT row, word FROM (SELECT *, count(*) OVER (PARTITION BY row) AS many FROM held) WHERE many > 1),
agreed AS (
    SELECT row, template, name, place - pos AS shift, count(*) AS agreeing, any_value(size) AS size
    FROM w JOIN voting USING (row, word) JOIN entries USING (word) GROUP BY ALL
    HAVING count(*) >= ceil({scan.agree} * any_value(size) / 10)
), verified AS (
    SELECT a.row, a.name, agreeing / size AS share FROM agreed a JOIN d USING (row)
    WHERE NOT EXISTS (
        SELECT 1 FROM phrases p WHERE p.template = a.template AND (a.shift + p.pos < 0
            OR array_to_string(d.words[a.shift + p.pos + 1 : a.shift + p.pos + p.n], ' ') <> p.phrase)
    )
), starts AS (
    SELECT row, place, label FROM w JOIN d USING (row), base
    WHERE word = split_part(phrase, ' ', 1) AND array_to_string(words[place + 1 : place + n], ' ') = phrase
), per AS (
    SELECT row, count(*) AS n_base, min(place) AS first_word, max(place) AS last_word,
        string_agg(DISTINCT label, ',' ORDER BY label) AS base_labels
    FROM starts GROUP BY row
), every AS (SELECT row, label FROM starts UNION SELECT row, name FROM verified),
listed AS (SELECT row, string_agg(label, ',' ORDER BY label) AS labels FROM every GROUP BY row),
best AS (SELECT row, max(share) AS share FROM verified GROUP BY row)
SELECT doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
    coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
    coalesce(share, CASE WHEN n_base > 0 THEN 0.5 ELSE 0.0 END)::DOUBLE AS score
FROM d LEFT JOIN per USING (row) LEFT JOIN listed USING (row) LEFT JOIN best USING (row)
"""


OP3_SQL = _sql()
