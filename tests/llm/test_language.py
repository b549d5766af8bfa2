import random

from termlode.llm.language import declared_language, host_parts, identify, labelled_sample, page_words

from .conftest import found

WORDS = {
    "en": "the and of with that this from house water stone".split(),
    "de": "der und die mit nicht schön haus wasser straße zeit".split(),
}


def text(rng, language, n=40):
    return " ".join(rng.choices(WORDS[language], k=n))


def test_evidence_is_fused(spark):
    rng = random.Random(1)
    documents = [(i, text(rng, lang), lang) for i, lang in enumerate(["en", "de"] * 40)]
    documents += [(None, None, None), (100, "", "en"), (101, "x", None), (102, "y", " ")]
    labelled = spark.createDataFrame(documents, "doc_id long, text string, lang string")
    pages = [(i, f"https://a.deutsch.de/{i}", f"<html lang=de><p>{text(rng, 'de')}</p>") for i in range(30)]
    pages += [(i, f"http://www.english.com/{i}", f"<p>{text(rng, 'en')}</p>") for i in range(30, 60)]
    # Without a text: the host decides, or what is declared, or the domain.
    pages += [(60, "https://a.deutsch.de/x", ""), (61, "http://www.english.com/y", None)]
    pages += [(62, "https://unknown.org/", "<html lang='de-AT'><p></p>"), (63, "https://b.deutsch.de/", "")]
    # A clear text outweighs the rest; nothing at all falls back on the prior.
    pages += [(64, "https://a.deutsch.de/z", f"<html lang=de><p>{text(rng, 'en', 400)}</p>"), (65, None, None)]
    pages += [(None, "not an address", "<p>the and of</p>")]
    schema = "page_id long, url string, html string, lang string, score string"
    frame = spark.createDataFrame([(*p, "x", "y") for p in pages], schema)
    got = identify(frame, labelled)
    lang = dict(found(got, "page_id", "lang"))
    assert len(lang) == got.count() == len(pages)
    assert all(lang[i] == ("de" if i < 30 else "en") for i in range(60))
    assert [lang[i] for i in (60, 61, 62, 63, 64)] == ["de", "en", "de", "de", "en"]
    assert all(0 < row["score"] <= 1 for row in got.collect())
    assert identify(frame.where("false"), labelled).count() == 0
    nothing = identify(frame, labelled.where("false"))
    assert nothing.columns == got.columns and nothing.where("lang IS NULL").count() == len(pages)


def test_parts_of_pages_and_addresses():
    assert declared_language("<html class=x LANG = 'pt-BR'>") == "pt"
    assert declared_language("<p lang=en>") == declared_language("") == ""
    assert host_parts("https://u@Sub.Shop.co.uk:80/x") == ("sub.shop.co.uk", "co.uk", "uk")
    assert host_parts("http://10.0.0.1/") == ("10.0.0.1", "10.0.0.1", "")
    assert host_parts(None) == host_parts("x") == ("", "", "")
    assert page_words("<script>no</script><b>Ab</b>-c 12 &amp; <!-- d") .split() == ["ab", "c"]


def test_the_sample_has_every_language_and_no_repeats(spark):
    rows = [(i, f"text {i}", f"l{i % 90:02d}") for i in range(900)]
    rows += [(None, "the same", "l00")] * 500 + [(1, "", "empty"), (2, "x" * 9000, "long"), (3, "t", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    texts, labels = labelled_sample(frame, 5)
    assert sorted(set(labels)) == [f"l{k:02d}" for k in range(90)]
    assert all(labels.count(x) == 5 for x in set(labels)) and len(set(texts)) == len(texts)
    assert labelled_sample(frame.repartition(7), 5) == (texts, labels)
