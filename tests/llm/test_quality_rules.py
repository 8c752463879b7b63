import random

import duckdb

from ledgerlens.llm import quality_rules as Q

TEXTS = [
    None,
    "",
    " \t\n",
    "one",
    "a b c d e f g h " * 3,
    "w\x1cx y z " * 30,
    "x # $ % " * 10 + "\n" + "same line\nsame line\n \n\n",
    " ".join(f"word{i}" for i in range(300)),
    "STOP!! " * 25,
    "no no no no no no no no no no " * 3,
    "".join(chr(0x4E00 + 7 * i) for i in range(400)) + "。 คน ไทย かな，\U00020001 plain",
    "é" * 50_000 + " " + " ".join(str(i % 97) for i in range(2_000)),
]


#: first and last of each block of the scripts without spaces
UNSPACED = [("\u0e00", "\u0eff"), ("\u1000", "\u109f"), ("\u1780", "\u17ff"), ("\u3000", "\u30ff"), ("\u3400", "\u4dbf"), ("\u4e00", "\u9fff"), ("\uf900", "\ufaff"), ("\uff00", "\uffef"), ("\U00020000", "\U0003ffff")]


def brute(text):
    text = text or ""
    words, at = [], ""
    for c in text + " ":
        if c in "\x20\t\n\x0b\x0c\r":
            words, at = (words + [at] if at else words), ""
        else:
            at += c
    seen = {}
    for i in range(len(words) - 7):
        seen.setdefault(tuple(words[i : i + 8]), []).append(i)
    covered = {i + o for v in seen.values() if len(v) > 1 for i in v for o in range(8)}
    lines = [x for x in text.split("\n") if x.strip("\x20\t\n\x0b\x0c\r")]
    return (
        len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
        sum(x in lines[:i] for i, x in enumerate(lines)), len(covered), len(lines), text.count("!"),
        sum(any(a <= c <= z for a, z in UNSPACED) for c in text),
    )


def frame(spark, texts=TEXTS):
    rows = [(i % 4 or None, t, "x", 7) for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_words int")


def test_measurements_match_brute_force(spark):
    docs = frame(spark)
    got = Q.ledger(docs).collect()
    assert len(got) == len(TEXTS)
    assert sorted(tuple(r[m] for m in Q.MEASURES) for r in got) == sorted(map(brute, TEXTS))


def test_small_flushes_change_nothing(monkeypatch):
    whole = Q.measure(TEXTS)
    monkeypatch.setattr(Q, "WORDS_AT_ONCE", 5)
    assert Q.measure(TEXTS).equals(whole)


def test_policies_read_the_bits_only(spark):
    rows = Q.ledger(frame(spark)).select("failed_bits")
    kept = Q.apply_policy(rows, Q.BASE).filter("kept").count()
    assert kept == Q.apply_policy(rows, Q.Policy("x", ("too_short", "repetitive"))).filter("kept").count()
    assert Q.apply_policy(rows, Q.Policy("none", ())).filter("kept").count() == len(TEXTS)


def test_ablation_equals_new_policies(spark):
    rows = Q.ledger(frame(spark)).select("failed_bits")
    found = {r["rule"]: r for r in Q.ablation(rows, Q.STRICT).collect()}
    assert set(found) == set(Q.STRICT.rules)
    for rule in (r for r in Q.RULES if r.name in Q.STRICT.rules):
        without = Q.Policy("w", tuple(r for r in Q.STRICT.rules if r != rule.name))
        assert found[rule.name]["n_kept_without"] == Q.apply_policy(rows, without).filter("kept").count()
        assert found[rule.name]["n_failed"] == rows.filter(f"failed_bits & {rule.mask} != 0").count()


def test_texts_of_scripts_without_spaces_are_kept(spark):
    """Their stretches between spaces are long; the rule on long words is for letters with spaces."""
    r = random.Random(3)
    sentence = lambda first, n, stop: "".join(chr(first + r.randrange(n)) for _ in range(r.randint(20, 40))) + stop
    texts = [" ".join(sentence(0x4E00, 5000, "。") for _ in range(30)), " ".join(sentence(0x0E01, 45, "") for _ in range(40)), "\n".join(sentence(0x3041, 80, "。") for _ in range(25))]
    glued = " ".join("".join(r.choice("abcdefgh") for _ in range(30)) for _ in range(40))
    df = spark.createDataFrame(list(enumerate([*texts, glued])), "doc_id long, text string")
    assert [r["kept"] for r in Q.judged(df).orderBy("doc_id").collect()] == [True, True, True, False]
    kept = Q.apply_policy(Q.ledger(df), Q.STRICT_2).orderBy("doc_id").collect()
    assert not any(r["kept"] for r in kept)


def test_empty_table(spark):
    docs = frame(spark).limit(0)
    assert Q.judged(docs).count() == 0
    assert Q.ablation(Q.ledger(docs), Q.STRICT).count() == 0
    assert Q.summary(Q.ledger(docs), "source").count() == 0


def test_sql_form(spark):
    rows = [(i, t) for i, t in enumerate(TEXTS)]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", rows)
    want = con.execute(Q.JUDGED_SQL + " ORDER BY doc_id").fetchall()
    got = Q.judged(spark.createDataFrame(rows, "doc_id long, text string")).orderBy("doc_id")
    assert [tuple(r) for r in got.collect()] == want
