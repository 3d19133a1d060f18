import re
from collections import Counter

from dialogprep.llm import quality
from tests.llm.cases import documents, empty, prose, texts

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    w = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    seen = Counter(zip(w, w[1:], w[2:]))
    covered = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)


def test_counts_equal_brute_force(spark):
    rows = texts() + [(30, "a b c a b c a b\na b c\n#1 <b> a|b & $5\na b c", "en", "s"), (31, "a a a a", "en", "s"), (32, "x y z w", "en", "s")]
    got = quality.score(documents(spark, rows, clash=["n_words", "kept", "cleaned", "_words"])).collect()
    assert len(got) == len(rows)
    want = Counter((i, counts(t)) for i, t, *_ in rows)
    assert want == Counter((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words)) for r in got)
    for r in got:
        n, *_, repeated = counts(r.text)
        assert r.base_failed == (n < 50 or 100 * repeated > 50 * n)
        assert not (r.kept and r.base_failed)


def test_line_rules_reject_furniture_and_keep_prose(spark):
    import random

    r = random.Random(3)
    vary = lambda n: " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(n))
    good = "\n".join(f"{vary(20).capitalize()}." for _ in range(5))
    rows = [
        (1, good, "en", "s"), (2, good + "\nHome | About | Contact | Help", "en", "s"), (3, "\n".join(" | ".join(vary(1) for _ in range(20)) for _ in range(5)), "en", "s"),
        (4, " ".join(w + "###" for w in vary(100).split()), "en", "s"), (5, vary(100).upper() + ".", "en", "s"), (6, "\n".join(vary(1) for _ in range(90)), "en", "s"),
    ]
    got = {x.doc_id: x for x in quality.score(documents(spark, rows)).collect()}
    assert [got[i].kept for i in range(1, 7)] == [True, True, False, False, False, False]
    assert "About" not in got[2].cleaned and got[2].cleaned == good
    kept = quality.accepted(documents(spark, rows, clash=["n_words"]))
    assert sorted(x.doc_id for x in kept.collect()) == [1, 2] and kept.columns[-1] == "n_words"
    assert quality.accepted(empty(spark)).count() == 0


def test_no_exchange(spark):
    plan = quality.score(documents(spark))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_long_repeated_text(spark):
    text = prose(1, 300) + " " + prose(1, 300)
    got = quality.score(documents(spark, [(1, text, "en", "s")])).first()
    assert got.n_repeat_words == counts(text)[4]


def test_accepted_texts_lose_failing_lines_only(spark):
    import random

    r = random.Random(3)
    lines = [" ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(20)).capitalize() + "." for _ in range(5)]
    good = "\n".join([lines[0], "", lines[1], lines[2], lines[3], lines[4], lines[0]])
    bad = good.replace("\n\n", "\nHome | About | Contact | Help\n\nThis site uses cookies.\n") + "\nRead more"
    docs = documents(spark, [(1, good, "en", "s"), (2, bad, "en", "s")]).selectExpr("*", "length(text) as n_chars")
    got = {x.doc_id: (x.text, x.n_chars) for x in quality.accepted(docs).collect()}
    assert got == {1: (good, len(good)), 2: (good, len(good))}
