import random
import zlib
from collections import Counter

import pytest

from ledgerlens.llm import spelling_variants as S

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def edits(word, letters):
    out = {word[:i] + word[i + 1 :] for i in range(len(word))}
    for c in letters:
        out |= {word[:i] + c + word[i:] for i in range(len(word) + 1)}
        out |= {word[:i] + c + word[i + 1 :] for i in range(len(word))}
    return out - {word}


def brute(counts, ratio=5):
    letters = set("".join(counts))
    near = {w: [x for x in edits(w, letters) if x in counts] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), counts.get(form[w])))
    return sorted(out)


def answers(df):
    return sorted(tuple(r) for r in df.select(COLUMNS).collect())


def made(n, letters, lengths, seed):
    r = random.Random(seed)
    words = {"".join(r.choice(letters) for _ in range(r.choice(lengths))) for _ in range(n)}
    for w in sorted(words)[: n // 2]:
        words.add(r.choice(sorted(edits(w, letters))))
    return {w: r.choice([5, 6, 20, 25, 100, 130, 700, 5000]) for w in words if w}


@pytest.mark.parametrize("letters,lengths,bucket", [("ab", [5, 6, 7, 8], 4), ("abé", [6, 7], 1024), ("aÿ", [1, 2, 3, 4], 1), ("abcdefgh", [6, 9, 12], 2)])
def test_equals_all_pairs(spark, letters, lengths, bucket):
    counts = made(250, letters, lengths, 7)
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert answers(S.variants(df, bucket=bucket)) == brute(counts)


def test_one_chunk_in_all_words(spark):
    """Words that share a half are paired by smaller and smaller chunks, and none is lost."""
    r = random.Random(2)
    counts = {"prefix" + "".join(r.choice("abc") for _ in range(6)): r.choice([5, 30, 900]) for _ in range(600)}
    df = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert answers(S.variants(df, bucket=16)) == brute(counts)


def test_chain_of_forms_ties_and_repeated_rows(spark):
    rows = [("abcdefg", 5), ("abcdefx", 25), ("abcdeyx", 130), ("abcdzyx", 700), ("bbcdefg", 25), (None, 9), ("nothing", None), ("abcdzyx", 0)]
    got = {r[0]: r[1:] for r in answers(S.variants(spark.createDataFrame(rows, "word string, n long")))}
    # Of two near words with 25, the first by code points.
    assert got["abcdefg"] == ("abcdefx", "abcdzyx", 5, 2, 25)
    assert got["abcdzyx"] == (None, "abcdzyx", 700, 1, None)
    assert got["bbcdefg"] == (None, "bbcdefg", 25, 1, None)
    assert len(got) == 5


def words_of(rows):
    found = Counter()
    for i, text in rows:
        run = ""
        for c in (text or "") + " ":
            if c.isascii() and c.isalpha() or "À" <= c <= "ÿ":
                run += c.lower() if c.isascii() else c
            elif run:
                h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
                if h % 199 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                found[run] += 1
                run = ""
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def test_documents_with_nulls_accents_and_long_texts(spark):
    r = random.Random(5)
    vocabulary = ["Straßenbahn", "STRASSENBAHN", "éléphant", "ÉLÉPHANT", "elephant", "word×word", "Schlüssel", "kurz", "a" * 700]
    rows = [(i if i % 9 else None, " ".join(r.choice(vocabulary) + r.choice([" ", ", ", "1", "\n", "_"]) for _ in range(80))) for i in range(150)]
    rows += [(1000, None), (1001, ""), (1002, "12 34 !!"), (1003, "Straßenbahn elephant " * 60_000)]
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, word string, n int")
    got = answers(S.digest(df))
    assert got == brute(words_of(rows))
    assert any(row[1] for row in got)


def test_empty_tables(spark):
    assert answers(S.digest(spark.createDataFrame([], "doc_id long, text string"))) == []
    assert answers(S.variants(spark.createDataFrame([], "word string, n long"))) == []
