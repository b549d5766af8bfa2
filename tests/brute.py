"""The same semantics as plain loops over plain Python data."""

import math
import re
from collections import Counter


def tokens(text):
    text = re.sub(r"\\[a-z]", " ", (text or "").lower()).replace("-", " ")
    found = []
    for word in re.split(r"[ \t\n\r\f]+", text):
        word = re.sub(r"""[\\0-9~`!@#$%^&*()\-_+=,.<>?/'":;{}\[\]|]""", "", word)
        if word:
            found.append(word)
    return found


def _tables(docs):
    counts = {doc_id: Counter(tokens(text)) for doc_id, text in docs}
    df = Counter(term for count in counts.values() for term in count)
    return counts, df


def bm25(docs, query, tf_scale=1.0, k1=2.0, b=0.75):
    counts, df = _tables(docs)
    lengths = {doc_id: sum(count.values()) for doc_id, count in counts.items()}
    avg = sum(lengths.values()) / len(lengths)
    scores = {}
    for doc_id, count in counts.items():
        score = 0.0
        for term in set(tokens(query)):
            if count[term]:
                idf = math.log((len(docs) - df[term] + 0.5) / (df[term] + 0.5) + 1)
                f = tf_scale * count[term]
                score += idf * f * (k1 + 1) / (f + k1 * (1 - b + b * lengths[doc_id] / avg))
        scores[doc_id] = score
    return scores


def tfdf(docs, query):
    counts, df = _tables(docs)
    asked = Counter(tokens(query))
    return {
        doc_id: sum(q / df[t] * count[t] / df[t] for t, q in asked.items() if count[t])
        for doc_id, count in counts.items()
    }


def top(scores, n):
    def key(item):
        return (-round(math.log(item[1]) * 1e9) if item[1] else math.inf, item[0])

    ranked = sorted(scores.items(), key=key)[:n]
    return [(rank, doc_id, score) for rank, (doc_id, score) in enumerate(ranked, 1)]
