"""Whole texts of longer licences are found, and notices in other punctuation."""

import os

import pytest

from bylinelake.llm import licenses

FOLDER = "/usr/share/common-licenses"


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="no licence texts here")
def test_long_texts(spark, docs):
    files = {"Apache-2.0": "Apache-2.0", "GPL-3": "GPL-3.0", "GPL-2": "GPL-2.0", "LGPL-2.1": "LGPL-2.1", "MPL-2.0": "MPL-2.0", "CC0-1.0": "CC0-1.0"}
    files = {f: n for f, n in files.items() if os.path.isfile(f"{FOLDER}/{f}")}
    texts = [open(f"{FOLDER}/{f}", encoding="utf-8").read() for f in files]
    changed = ["Copyright (c) 2020 Someone\n" + t.upper().replace(",", " ;") for t in texts]
    out = {r["doc_id"]: r["license"] for r in licenses.scan(docs(texts + changed + [texts[0] + " and more", None, ""])).collect()}
    n = len(files)
    assert [out[i] for i in range(2 * n)] == [*files.values()] * 2 and [out[i] for i in range(2 * n, 2 * n + 3)] == [None] * 3


def test_notice_punctuation_nulls_and_empty_tables(docs):
    out = {r["doc_id"]: (r["license"], r["notices"]) for r in licenses.scan(docs(["This work is in the public-domain.", "x\nThis work is in the Public  Domain.", None, "MIT"], ids=[1, 2, None, 3])).collect()}
    assert out == {1: ("CC0-1.0", "CC0-1.0"), 2: (None, "CC0-1.0"), None: (None, ""), 3: (None, "")}
    assert licenses.scan(docs(["x"]).limit(0)).count() == 0
    twice = licenses.scan(docs(["Licensed under CC BY 4.0.", "nothing"], ids=[7, 7])).collect()
    assert [(r["doc_id"], r["notices"]) for r in twice] == [(7, "CC-BY-4.0")] * 2
