"""Spans against Python's own matching, and the ledger."""

from __future__ import annotations

import dataclasses
import hashlib
import re
import time

from pricelake.llm.secret_scan import RULES, blobs, scan, scan_unseen, span_text
from tests.llm.edge import documents, edge_docs, no_docs

ASSIGN = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)
TEXTS = [
    'é password = "hunter22" then TOKEN:abc then Api_Key=\'zzzzzz\'', "secret=token: abcdefgh", "token=secret=abcdef token==abcdefg", "😀 token: aaaaaa",
    "AKIA" + "A" * 16 + " AKIA" + "B" * 15 + " AKIAAKIA" + "C" * 12, "0123456789abcdef01234567 x0123456789abcdef0123456", "passwd:  'aé", "",
    "token=" + "f" * 30 + "\nAKIAX" + "9" * 40, "no secrets here", "secret : : abcdef", "ppassword=abcdefgh;secret\"=\"q_w.e-r+t/y=",
]


def expected(text):
    out = [(m.start(), 0, m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return ",".join(f"{k}:{a}:{b}" for a, _, b, k in sorted(out))


def told(found):
    return sorted((r["path"], r["s"]) for r in found.select("path", span_text(found["found"]).alias("s")).collect())


def test_spans(spark):
    rows = list(enumerate(TEXTS)) + [(100, TEXTS[0])]
    found, _ = scan(documents(spark, rows))
    assert told(found) == sorted((i, expected(t)) for i, t in rows)


def test_only_unseen_blobs_and_rule_versions_are_scanned(spark):
    _, ledger = scan(documents(spark, [(1, TEXTS[0]), (2, TEXTS[4])]))
    later = documents(spark, [(1, TEXTS[0]), (3, TEXTS[0]), (4, TEXTS[5])])
    added = scan_unseen(blobs(later), ledger).collect()
    assert {r["blob"] for r in added} == {hashlib.sha256(TEXTS[5].encode()).hexdigest()} and len(added) == 3
    found, whole = scan(later, ledger)
    assert told(found) == sorted((i, expected(t)) for i, t in ((1, TEXTS[0]), (3, TEXTS[0]), (4, TEXTS[5])))
    newer = (dataclasses.replace(RULES[0], version=2, least=8), *RULES[1:])
    added = scan_unseen(blobs(later), whole, newer).collect()
    assert {(r["kind"], r["version"]) for r in added} == {("assign", 2)} and len(added) == 2


def test_edge_cases(spark):
    found, _ = scan(edge_docs(spark))
    assert found.count() == 11 and {s for _, s in ((r["path"], r["s"]) for r in found.select("path", span_text(found["found"]).alias("s")).collect())} == {""}
    found, ledger = scan(no_docs(spark))
    assert found.collect() == [] and ledger.collect() == []


def test_many_findings_in_one_text_take_time_in_proportion(spark):
    def seconds(n):
        text = " ".join(f"token=abcdef{i:07d}" for i in range(n))
        begin = time.perf_counter()
        found, _ = scan(documents(spark, [(1, text)]))
        assert told(found) == [(1, expected(text))]
        return time.perf_counter() - begin

    seconds(100)
    small, large = seconds(5_000), seconds(40_000)
    assert large < 16 * small + 2
