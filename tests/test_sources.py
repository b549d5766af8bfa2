import json

import pytest

import termlode

RECORDS = [
    {
        "id": "12",
        "url": "https://en.wikipedia.org/wiki?curid=12",
        "title": "Anarchism",
        "text": 'Anarchism\n\nAnarchism is a café "x" well-known. 1990s {y=2}',
    },
    {"id": "39", "url": "https://example.org/title?curid=39", "title": "Plain", "text": "just words"},
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    """One file at the top and one below, with escaped characters as in a dump."""
    top = tmp_path_factory.mktemp("dump")
    (top / "nested" / "deep").mkdir(parents=True)
    (top / "part1").write_text(json.dumps(RECORDS[0]) + "\n")
    (top / "nested" / "deep" / "part2").write_text(json.dumps(RECORDS[1]) + "\n")
    return str(top)


def tokens(corpus):
    frame = corpus.select("doc_id", termlode.tokenize(corpus["text"]).alias("tokens"))
    return {row["doc_id"]: " ".join(row["tokens"]) for row in frame.collect()}


def test_decoded(spark, folder):
    corpus = termlode.read_json_corpus(spark, folder)
    assert tokens(corpus) == {
        "12": "anarchism anarchism is a café x well known s y",
        "39": "just words",
    }
    rows = {r["doc_id"]: (r["title"], r["url"]) for r in corpus.collect()}
    assert rows == {r["id"]: (r["title"], r["url"]) for r in RECORDS}


def test_raw(spark, folder):
    corpus = termlode.read_raw_corpus(spark, folder)
    assert tokens(corpus) == {
        "12": "anarchism anarchism is a caf e x well known s y",
        "39": "just words",
    }
    rows = {r["doc_id"]: (r["title"], r["url"]) for r in corpus.collect()}
    assert rows == {r["id"]: (r["title"], r["url"]) for r in RECORDS}


def test_raw_line_without_a_text_key(spark, tmp_path):
    (tmp_path / "part").write_text('{"id": "7", "url": "u"}\n')
    row = termlode.read_raw_corpus(spark, str(tmp_path)).first()
    assert (row["doc_id"], row["text"]) == ("7", '7", "url": "u"}')


def test_broken_line_fails(spark, tmp_path):
    (tmp_path / "part").write_text(json.dumps(RECORDS[1]) + '\n{"id": "8", "url\n')
    with pytest.raises(Exception, match="(?i)malformed"):
        termlode.read_json_corpus(spark, str(tmp_path)).collect()


def test_record_without_a_text_is_empty(spark, tmp_path):
    (tmp_path / "part").write_text('{"id": "7", "url": "u"}\n')
    index = termlode.build_index(termlode.read_json_corpus(spark, str(tmp_path)))
    assert [tuple(r) for r in index.doc_lengths.collect()] == [("7", 0)]


def test_search_over_files(spark, folder, tmp_path):
    corpus = termlode.read_json_corpus(spark, folder)
    index = termlode.write_index(corpus, str(tmp_path / "index"), shards=2)
    found = termlode.with_metadata(termlode.bm25_search(index, "words", 1), corpus).collect()
    assert [(r["doc_id"], r["title"], r["url"]) for r in found] == [
        ("39", "Plain", "https://example.org/title?curid=39")
    ]
