from __future__ import annotations

import hashlib
import re

from airstrata.llm import merkle
from tests.llm.helpers import documents, odd_rows


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def brute(text):
    text = text or ""
    parts = re.findall(merkle.PARAGRAPH, text) or [""]
    sections, now = [], []
    for p in parts:
        codes = ".".join(md5(u)[:6] for u in re.findall(merkle.UNIT, p))
        now.append(f"{md5(p)[:8]}:{codes}")
        if md5(p)[0] < "4":
            sections.append(now)
            now = []
    sections += [now] if now else []
    digests = [md5(",".join(re.sub(":.*", "", p) for p in s))[:8] for s in sections]
    root = hashlib.sha256((md5(text) + ";".join(digests)).encode()).hexdigest()[:32]
    return root + "|" + ";".join(d + "/" + ",".join(s) for d, s in zip(digests, sections, strict=True))


def codes(print_):
    return set(re.findall(r"(?<=[:.])[0-9a-f]{6}", print_))


def near(a, b):
    if a == b:
        return 1.0
    x, y = codes(a), codes(b)
    return 2 * len(x & y) / (len(x) + len(y)) if x or y else 0.0


def test_against_brute_force(spark):
    rows = odd_rows()
    texts = sorted({(r[0] is not None, r[0] or 0, r[1] or "") for r in rows},
                   key=lambda r: (r[0], r[1], md5(f"{r[1] if r[0] else 'null'}:{r[2]}")))
    follows = {texts[i]: texts[(i + 1) % len(texts)] for i in range(len(texts))}
    want = []
    for doc_id, text, *_ in rows:
        text = text or ""
        has_id, next_id, after = follows[(doc_id is not None, doc_id or 0, text)]
        n = len(text) // 4
        edited = text[: len(text) - n] + after[:n]
        a, b, c = brute(text), brute(edited), brute(after)
        want.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), a, b, near(a, b), near(a, c), next_id if has_id else None))
    got = [tuple(r) for r in merkle.fingerprint_edits(documents(spark)).collect()]
    assert sorted(map(repr, got)) == sorted(map(repr, want))


def test_changed_paragraphs(spark):
    old = "".join(f"Line {i} stays.\n" for i in range(40))
    new = old.replace("Line 7 ", "Line seven ").replace("Line 30 ", "Line thirty ")
    frame = spark.createDataFrame([(old, new), (old, old), (None, "a")], "old string, new string")
    prints = frame.select(merkle.fingerprint(frame["old"]).alias("a"), merkle.fingerprint(frame["new"]).alias("b"))
    found = prints.select(merkle.changed_paragraphs(prints["a"], prints["b"]).alias("at"), (merkle.root(prints["a"]) == merkle.root(prints["b"])).alias("same"))
    assert [(r["at"], r["same"]) for r in found.collect()] == [([7, 30], False), ([], True), ([0], False)]


def test_empty_and_single(spark):
    assert merkle.fingerprint_edits(documents(spark, [])).count() == 0
    row = merkle.fingerprint_edits(documents(spark, [(1, "abcd", *[None] * 6)])).first()
    assert row["edited_sha256"] == hashlib.sha256(b"abca").hexdigest() and row["near_next"] == 1.0
