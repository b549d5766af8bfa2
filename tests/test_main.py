import json

import pytest

from termlode.__main__ import main

RECORDS = [
    {"id": "1", "url": "u1", "title": "Fruit", "text": "Red apple, red pear."},
    {"id": "2", "url": "u2", "title": "Pie", "text": "Apple-pie\napple!"},
    {"id": "3", "url": "u3", "title": "Year", "text": "1999 ..."},
    {"id": "4", "url": "u4", "title": "Tree", "text": "Green tree"},
]


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    folder = tmp_path_factory.mktemp("dump")
    (folder / "part").write_text("".join(json.dumps(record) + "\n" for record in RECORDS))
    return str(folder)


@pytest.mark.parametrize("raw", [[], ["--raw"]])
def test_index_and_search(spark, corpus, tmp_path, capsys, raw):
    root = str(tmp_path / "index")
    main(["index", corpus, root, "--shards", "2", *raw])
    query = "red red apple zebra"
    main(["search", query, "3", root, str(tmp_path / "bm25")])
    lines = capsys.readouterr().out.splitlines()
    assert [line.split("\t")[1] for line in lines] == ["1", "2", "3"]
    assert lines[0].startswith("1\t1\tFruit\tu1\t1.897")
    assert lines[2].endswith("\t0.0")
    assert spark.read.parquet(str(tmp_path / "bm25")).count() == 4

    main(["search", query, "1", root, str(tmp_path / "dot"), "--ranking", "tfdf"])
    assert capsys.readouterr().out.endswith("\t4.25\n")
    with pytest.raises(ValueError):
        main(["search", query, "1001", root, str(tmp_path / "no")])
    with pytest.raises(Exception, match="(?i)exists"):
        main(["search", query, "1", root, str(tmp_path / "bm25")])
