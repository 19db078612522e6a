import hashlib

import pytest

from tilewright.llm import fill_in_middle as fim

TEXTS = ["", None, "a", "ab 😀 漢字 é\r\n\nx", "one <P> two", "<S>", "< S><<P", "line\n" * 3, " lead  two\tthree ", "😀" * 500, "x" * 50_000, "…"]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(k * 7 + i, t) for k in range(12) for i, t in enumerate(TEXTS)] + [(None, "no id"), (3, "twice"), (3, "twice")]
    return spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n", "'y' as form", "2 as units", "3 as a", "4 as output")


def brute(doc_id, text, cut, seed=1):
    text = text or ""
    x = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(x[8 * k : 8 * k + 8], 16) for k in range(4)]
    parts = cut(text)
    n = len(parts)
    if not text or any(m in text for m in fim.MARKS) or h[2] % 100 >= 90:
        return doc_id, n, "plain", text
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    return (doc_id, n, "spm", f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (doc_id, n, "psm", f"<P>{p}<S>{s}<M>{m}")


def words(text):
    out = []
    for c in text:
        if not out or (out[-1][-1] in " \t\n\v\f\r" and c not in " \t\n\v\f\r"):
            out.append("")
        out[-1] += c
    return out


def lines(text):
    *whole, last = text.split("\n")
    return [x + "\n" for x in whole] + [last] * bool(last)


@pytest.mark.parametrize("grammar, cut", [("code points", list), ("lines", lines), ("words", words)])
def test_against_brute_force(docs, grammar, cut):
    rows = fim.restored(fim.fill_in_middle(docs, grammar)).collect()
    assert len(rows) == docs.count()
    want = sorted((brute(r.doc_id, r.text, cut) for r in docs.select("doc_id", "text").collect()), key=str)
    assert sorted(((r.doc_id, r.n, r.form, r.output) for r in rows), key=str) == want
    assert all(r.restored == r.text for r in rows)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}


def test_units_put_together_are_the_text(spark, docs):
    for grammar in fim.GRAMMARS.values():
        rows = docs.selectExpr("coalesce(text, '') as t").select("t", fim.units(fim.F.col("t"), grammar).alias("u")).collect()
        assert all("".join(r.u) == r.t and "" not in r.u for r in rows)
    runs = spark.createDataFrame([("héllo, wörld 12!?",)], "t string").select(fim.units(fim.F.col("t"), fim.GRAMMARS["runs"]).alias("u")).first().u
    assert runs == ["héllo", ",", " ", "wörld", " ", "12", "!?"]


def test_awkward_and_empty(awkward):
    rows = fim.restored(fim.fill_in_middle(awkward)).collect()
    assert sorted(r.restored for r in rows) == sorted(r.text or "" for r in awkward.collect())
    assert fim.fill_in_middle(awkward.limit(0)).count() == 0
