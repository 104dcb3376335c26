from __future__ import annotations

import re

from tidemark.llm.licenses import PHRASES, TEMPLATES, scan
from tidemark.llm.queries import QUERIES

SCHEMA = "doc_id long, text string, id string, words int, version int, label string"
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def base(text):
    w = words_of(text)
    at = [(i, label) for phrase, label in PHRASES for i in range(len(w)) if w[i : i + len(phrase.split())] == phrase.split()]
    first, last = (min(at)[0], max(at)[0]) if at else (None, None)
    return len(w), len(at), first, last, ",".join(sorted({x for _, x in at}))


def scanned(spark, rows):
    df = spark.createDataFrame([(*r, "x", 1, 2, "y") for r in rows], SCHEMA)
    return sorted(scan(df).collect(), key=lambda r: str(r.doc_id))


MIT, APACHE, BSD = TEMPLATES[1][1], TEMPLATES[3][1], TEMPLATES[6][1]


def test_templates_with_changes(spark):
    cut = BSD.split()
    edited = " ".join(cut[:12] + ["and", "extra"] + cut[12:20] + cut[21:])
    rows = [(1, "intro " * 50 + MIT + " outro"), (2, edited), (3, " ".join(BSD.split()[:10])), (4, "the mit license. MIT-LICENSE apache license mit"), (5, None), (6, ""), (None, APACHE), (8, "Émit license élicense"), (9, MIT + " x " * 300 + MIT)]
    got = scanned(spark, rows)
    by = {r.doc_id: r for r in got}
    assert by[1].labels == "mit" and by[1].spans[0].start == 50 and by[1].score == 1 and by[1].n_base == 0
    assert by[2].labels == "bsd" and 0.5 < by[2].score < 1
    assert by[3].labels == "" and by[3].score == 0 and by[3].spans == []
    assert (by[4].n_base, by[4].base_labels, by[4].score) == (3, "apache,mit", 0.5)
    assert by[5].n_words == 0 and by[6].n_words == 0 and by[None].labels == "apache"
    assert len(by[9].spans) == 2
    for (i, t) in rows:
        r = by[i]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(t)


def test_long_text_repeats_and_empty(spark):
    long = "word " * 50_000 + "Released under the MIT License. " + "word " * 50_000 + "general public license"
    got = scanned(spark, [(1, long), (1, long), (1, "other")])
    assert sorted((r.n_words, r.labels) for r in got) == [(1, ""), (100_008, "gpl,mit"), (100_008, "gpl,mit")]
    assert scanned(spark, []) == []


def test_query_base_columns(spark):
    data = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{data}/documents.parquet").collect()}
    got = QUERIES["op6_license_scan"](spark, data).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == base(texts[r.doc_id])
        assert set(r.base_labels.split(",")) - {""} <= set(r.labels.split(",")) and 0 <= r.score <= 1
        assert ("cc-by-nc" in r.labels) == ("licensed under cc by nc 4 0" in " ".join(words_of(texts[r.doc_id])))
