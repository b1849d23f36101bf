"""License scans against a plain search of every block."""

import re

from riskweave.llm import licenses, queries
from tests.conftest import SF_SMALL


def slow(text):
    words = [w for w in re.split(licenses.NOT_WORD, "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")) if w]
    base = [(i, label) for p, label in licenses.PHRASES.items() for i in range(len(words)) if words[i:i + len(p.split())] == p.split()]
    found = {}
    for n in licenses.notices(licenses.NOTICES, licenses.CONTAINMENT):
        for i in range(0, len(words), n.length):
            got = len(n.words & set(words[i:i + 2 * n.length]))
            if got >= n.needed:
                found[n.label] = max(found.get(n.label, 0), got / len(n.words))
    own = sorted({label for _, label in base})
    return (len(words), len(base), min((i for i, _ in base), default=None), max((i for i, _ in base), default=None),
            ",".join(own), ",".join(sorted({*own, *found})), 1.0 if base else max(found.values(), default=0.0))


def shape(r):
    return (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score)


def test_rows(spark):
    filler = " filler words that tell nothing" * 40
    texts = [None, "", "Under the MIT License", "x under the mit license under the mit license", "CC BY-NC and cc by\nnc",
             "apache license version 2", "All Rights\nReserved", filler + licenses.NOTICES[2][1] + filler,
             filler + licenses.NOTICES[2][1].replace("copy", "kopie") + filler, licenses.NOTICES[11][1].replace("NC", "SA"),
             "the the the license of of to and", "Ünder the mit license", "This work is licensed under the GNU General Public License, version 3."]
    rows = [(i, t, "x") for i, t in enumerate(texts)] + [(6, texts[6], "x"), (None, texts[6], "x")]
    got = licenses.scan(spark.createDataFrame(rows, "doc_id int, text string, labels string")).collect()
    assert sorted((r.doc_id if r.doc_id is not None else -1, *map(str, shape(r))) for r in got) == sorted(
        (i if i is not None else -1, *map(str, slow(t))) for i, t, _ in rows)
    assert licenses.scan(spark.createDataFrame([], "doc_id int, text string")).count() == 0


def test_each_notice_is_found(spark):
    filler = "other words before and after " * 30
    rows = [(i, filler + text + " " + filler) for i, (_, text) in enumerate(licenses.NOTICES)]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id int, text string")).collect()}
    for i, (label, _) in enumerate(licenses.NOTICES):
        assert label in got[i].labels.split(",") and got[i].score == 1.0


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    got = queries.op2_licenses(spark, SF_SMALL).collect()
    assert len(got) == len(docs)
    assert all(shape(r) == slow(docs[r.doc_id]) for r in got)
    assert "Python" not in queries.op2_licenses(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
