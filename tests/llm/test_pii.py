"""Personal data: base spans against the patterns, votes, added spans."""

import hashlib
import re

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from revlens.llm import pii as P
from revlens.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def slow_base(t):
    t = t or ""
    out = [("email", m.start(), m.end()) for m in
           re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    out += [("ip", m.start(), m.end()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t)
            if all(int(p) <= 255 for p in m.group().split("."))]
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[ -]", "", m.group())
        if 13 <= len(d) <= 19 and P.luhn(d):
            out.append(("card", m.start(), m.end()))
    return out + [("phone", m.start(), m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t)
                  if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


@settings(max_examples=300, deadline=None)
@given(st.one_of(st.text(alphabet="a.@-%1 é", max_size=40), st.text(alphabet="0123.25 ", max_size=40),
                 st.text(alphabet="+(1) -.5", max_size=40)))
def test_base_spans_match_patterns(text):
    assert P.base_spans(text) == slow_base(text)


def test_query(spark):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    rows = QUERIES["op7_pii"][0](spark, SF).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = slow_base(texts[r.doc_id])
        joined = [f"{k}:{s}:{e}" for k, s, e in base]
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == x for x, _, _ in base) for k in P.KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(joined).encode()).hexdigest()
        assert set(joined) <= set(r.spans.split(",")) | ({""} if not joined else set())
    assert sum(r.n_email for r in rows) > 0


def test_em_trusts_the_reliable_labeler():
    rng = np.random.default_rng(3)
    y = rng.random(4000) < 0.4
    acc = (0.95, 0.9, 0.85, 0.8, 0.55)
    v = np.stack([np.where(rng.random(4000) < a, y, ~y) * 2 - 1 for a in acc], axis=1)
    pat, n = np.unique(v, axis=0, return_counts=True)
    post, tables = P.estimate(pat, n.astype(float))
    found = [tables[1, j, 2] for j in range(5)]
    assert np.allclose(found, acc, atol=0.06)
    p = {tuple(a): b for a, b in zip(pat, post)}
    assert np.mean([(p[tuple(a)] > 0.5) == b for a, b in zip(v, y)]) > 0.95


def test_added_spans_and_mask(spark):
    good = ["call +1 (269) 555-3296 today", "mail ab.12@mail8.example.com now", "from 70.123.182.155 at",
            "card 4041894974608795 ok", "no data here"]
    both = "x +1 (269) 555-3296 4524132264652876 y"
    docs = spark.createDataFrame([(i, good[i % 5], "t", 5) for i in range(200)]
                                 + [(500, both, "t", 38), (501, None, "n", 3), (502, "", "n", 0), (None, both, "t", 1),
                                    (503, "9" * 60000, "t", 1), (503, "9" * 60000, "t", 1),
                                    (504, 'token = "0641917ea4e9feb9c" v1.2.3', "t", 1)],
                                 "doc_id bigint, text string, spans string, n_chars bigint")
    rows = {r.doc_id: r for r in P.find(docs).collect()}
    assert rows[500].n_card == rows[500].n_phone == 0
    assert rows[500].spans == "card:20:36,phone:2:19"
    assert rows[501].spans == rows[502].spans == rows[503].spans == rows[504].spans == "" and rows[None].spans
    out = P.mask(docs)
    assert out.columns == docs.columns
    by = {r.doc_id: r for r in out.collect()}
    assert by[500].text == "x [PHONE] [CARD] y" and by[500].n_chars == 18 and by[500].spans == "t"
    assert by[501].text is None and by[501].n_chars == 3 and by[4].n_chars == 5
    assert by[1].text == "mail [EMAIL] now" and out.count() == docs.count()
    assert P.find(docs.limit(0)).count() == 0 and P.mask(docs.limit(0)).count() == 0


def test_pre_test_is_a_necessary_condition():
    """What is a candidate does not depend on the rest of the text."""
    for written in ("write to jane at example.com now", "jane at\texample.org", "jane (at) example (dot) org",
                    "x [at] mail [dot] example.net", "jane at example dot com"):
        alone = [written[s:e] for k, s, e in P.candidates(written, []) if k == "email"]
        both = f"x@ y {written}"
        assert len(alone) == 1 and alone == [both[s:e] for k, s, e in P.candidates(both, []) if k == "email"]
    assert not P.candidates("we met at home", [])


def test_country_codes():
    assert {"380", "1", "44", "971", "998", "212"} <= P._CODES and not {"210", "999x", "28", "3", "699"} & P._CODES
