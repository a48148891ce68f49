"""Fill-in-the-middle against a plain Python version, and its edge cases."""

import hashlib
import random
import re

from streamlens.llm import fim

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


def brute(i, text, seed=42, fim_percent=50, spm_percent=80):
    t = text or ""
    units = UNIT.findall(t)
    n = len(units)
    d = hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()
    h = [int(d[8 * k:8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim_percent:
        return n, "plain", None, None, t
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < spm_percent:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(spark, rows, **options):
    df = spark.createDataFrame([(i, t, "x", 7) for i, t in rows], "doc_id long, text string, form string, extra int")
    got = fim.restore(fim.transform(df, **options)).collect()
    assert len(got) == len(rows) and "extra" in got[0].asDict()
    assert sorted(((r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == sorted(
        ((i, *brute(i, t, **options)) for i, t in rows), key=repr)
    want = sorted(((i, t or "") for i, t in rows), key=repr)
    assert sorted(((r.doc_id, r.restored) for r in got), key=repr) == want
    return got


def test_matches_plain_version(spark):
    rng = random.Random(3)
    alphabet = "ab<>PSM \t\n\x0b\x0c\r\x1c\x85\xa0 é日\U0001f600$\\1"
    rows = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(60)))) for i in range(600)]
    got = check(spark, rows)
    assert {r.form for r in got} == {"plain", "spm", "psm"}
    check(spark, rows[:200], seed=7, fim_percent=100, spm_percent=50)


def test_edges(spark):
    rows = [(1, None), (2, ""), (None, "one two"), (None, "one two"), (3, " "), (4, "word"), (5, "a <P> b"), (6, "tail<"), (7, "P>head"),
            (8, "\n\n"), (9, "$1 \\E \\Q x")] * 2
    check(spark, rows, fim_percent=100)
    df = spark.createDataFrame([], "doc_id long, text string")
    assert fim.restore(fim.transform(df)).collect() == []


def test_very_long_texts(spark):
    """Neither many units nor a long unit or white space exhausts the stack of the regex engine."""
    rows = [(k, t) for k, t in enumerate(["w " * 400_000, "x" * 3_000_000, " " * 2_000_000 + "z", "a" + " " * 2_000_000, "\U0001f600 é\n" * 100_000])]
    got = check(spark, rows, fim_percent=100, spm_percent=50)
    assert all(r.form != "plain" for r in got)


def test_one_narrow_pass(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    plan = fim.restore(fim.transform(df))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
