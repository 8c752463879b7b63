import hashlib
import random

import pytest
import sentencepiece

import corpus_pipeline as P
from ledgerlens.llm import quality_rules, secrets

from .test_jaccard_join import brute
from .test_mixing import brute_targets
from .test_quality_rules import brute as measured

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LIB = sentencepiece.SentencePieceProcessor(model_file=P.public_tokenizers.path("piece_bpe_32k.model"))


def made():
    r = random.Random(8)
    word = lambda: "".join(r.choice("abcdeimnorst") for _ in range(r.randint(2, 8)))
    texts = []
    for i in range(60):
        words = [word() for _ in range(r.randint(30, 90))]
        texts.append(" ".join(words))
        if i % 5 == 0:
            texts += [" ".join(words), " ".join(words[:-1] + ["changed"])]
        if i % 7 == 0:
            texts.append(" ".join(words[::-1]) + " password=abcdefgh12 end " + "0123456789abcdef" * 3)
        if i % 9 == 0:
            texts.append("### " * 40 + " ".join(words[:20]))
    texts += [None, "", "short", "junk!! " * 50]
    return [(i, t, "en", r.choice(["a", "b", None]), len(t or "")) for i, t in enumerate(texts)]


def test_stages_against_brute_force(spark):
    rows = made()
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    kept = P.quality(spark, docs, "").collect()
    names = {m: k for k, m in enumerate(quality_rules.MEASURES)}

    def good(text):
        m = measured(text)
        n, chars, symbols, dups, repeats, lines, bangs, unspaced = (m[names[k]] for k in quality_rules.MEASURES)
        return n >= 20 and 100 * repeats <= 30 * n and 10 * symbols <= n and 100 * dups <= 45 * lines and 10 * bangs <= 3 * n and 2 * n <= chars and chars - unspaced <= 14 * n

    want = [r for r in rows if good(r[1])]
    assert sorted(tuple(r) for r in kept) == sorted(want, key=lambda r: r[0])

    docs = spark.createDataFrame(want, SCHEMA)
    one = sorted(tuple(r) for r in P.near_duplicates(spark, docs, "").collect())
    least = {c for _, _, c in brute([(r[0], r[1]) for r in want])[0]}
    assert [r for r in want if r[0] in least] == one

    clean = sorted(tuple(r) for r in P.secret_scans(spark, spark.createDataFrame(one, SCHEMA), "").collect())
    assert [r[0] for r in clean] == [r[0] for r in one]
    for before, after in zip(one, clean):
        if "password=" in before[1]:
            assert "abcdefgh12" not in after[1] and "[SECRET]" in after[1] and after[4] == len(after[1])
        else:
            assert after == before

    mixed = [tuple(r) for r in P.mix(spark, spark.createDataFrame(clean, SCHEMA), "").collect()]
    assert set(mixed) <= set(clean) and all(mixed.count(r) <= 2 for r in set(mixed))

    for r in P.encode(spark, spark.createDataFrame(mixed, SCHEMA), "").collect():
        text = next(x[1] for x in mixed if x[0] == r["doc_id"])
        ids = LIB.encode(text)
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def test_mix_fills_the_target_of_each_source(spark):
    """Sources of similar size: several are below their limit."""
    rows = [(i, t, lang, "abcdefg"[i % 7], n) for i, t, lang, _, n in made() if t]
    mixed = P.mix(spark, spark.createDataFrame(rows, SCHEMA).repartition(4), "").collect()
    sizes, taken = {}, dict.fromkeys("abcdefg", 0)
    for r in rows:
        sizes[r[3]] = sizes.get(r[3], 0) + len(r[1].split())
    for r in mixed:
        taken[r["source"]] += len(r["text"].split())
    largest = max(len(r[1].split()) for r in rows)
    for s, target in brute_targets(sizes).items():
        assert abs(taken[s] - target) <= largest / 2


@pytest.mark.parametrize("rows", [[], [(None, None, None, None, None)], [(1, "plain words " * 3, "en", "a", 36)] * 3])
def test_odd_tables(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    for _, stage in P.STAGES[:-1]:
        out = stage(spark, docs, "")
        assert out.columns == P.COLUMNS
        assert out.count() <= 2 * len(rows)
    assert P.STAGES[-1][1](spark, docs, "").count() == len(rows)


def test_names():
    assert [n for n, _ in P.STAGES] == ["quality_rules", "near_duplicates", "secret_scans", "mixing", "sentence_pieces"]
    assert secrets.KINDS[3] == "random"
