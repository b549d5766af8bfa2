import re

from termlode.llm.licenses import PHRASES, TEMPLATES, blocks_of, license_scan, words_of

from .conftest import found


def slow_words(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)


def brute(text, threshold=0.8):
    words = slow_words(text)
    places = [
        (i, label)
        for phrase, label in PHRASES.items()
        for i in range(len(words))
        if words[i : i + len(phrase.split())] == phrase.split()
    ]
    shares = {}
    for block in blocks_of(text or ""):
        for label, template in TEMPLATES.items():
            own = set(words_of(template))
            share = len(own & block) / len(own)
            if share >= threshold - 1e-9:
                shares[label] = max(share, shares.get(label, 0))
    base = {label for _, label in places}
    starts = [i for i, _ in places]
    return (
        len(words), len(places), min(starts, default=None), max(starts, default=None),
        ",".join(sorted(base)), ",".join(sorted(base | set(shares))),
        1.0 if base else max(shares.values(), default=0.0),
    )


def test_equals_brute_force(spark, hard_documents, hard_texts, no_documents):
    columns = ["n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    texts = [t for _, t in hard_texts]
    notices = [
        "GNU General Public License GNU general public license",
        "x CC BY-NC 4.0 cc\nby y",
        "Licensed under the Apache license, Version 2\n(the License)",
        "The software is provided 'as is', without warranty of kind.\nall RIGHTS reserved",
        "w " * 300 + "All rights reserved " + "v " * 300 + "MIT-License",
        "\n".join(TEMPLATES.values()),
    ]
    frame = spark.createDataFrame(
        [(i, t, "a", "b") for i, t in enumerate([*texts, *notices, notices[0]])],
        "doc_id long, text string, labels string, n_words string",
    )
    got = found(license_scan(frame), "doc_id", *columns)
    assert [row[1:] for row in got] == [brute(t) for t in [*texts, *notices, notices[0]]]
    assert license_scan(hard_documents).count() == len(hard_texts)
    assert license_scan(no_documents).count() == 0
