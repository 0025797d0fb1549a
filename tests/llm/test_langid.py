import numpy as np
from helpers import frame, messy

from snapledger.llm import langid

SMALL = "/root/testdata/sf0.01/documents.parquet"


def test_held_out_documents_get_their_language(spark):
    from snapledger.llm.queries import op3_language_id

    found = op3_language_id(spark, "/root/testdata/sf0.01").join(spark.read.parquet(SMALL).select("doc_id", "lang"), "doc_id")
    held = [r for r in found.collect() if r.held_out and r.lang]
    assert len(held) > 100 and np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in held)


def test_grams_of_a_text():
    keys, counts = langid.grams("Ab, a1b")
    shown = {tuple(int(k) >> s & 0x1FFFFF for s in (42, 21, 0)): int(c) for k, c in zip(keys, counts)}
    a, b, _ = ord("a"), ord("b"), 32
    assert shown == {
        (0, 0, a): 2, (0, 0, b): 2, (0, 32, a): 2, (0, 32, b): 1, (0, a, b): 1, (0, a, 32): 1, (0, b, 32): 2,
        (32, a, b): 1, (a, b, 32): 1, (32, a, 32): 1, (32, b, 32): 1,
    }


def test_distance_is_the_sum_of_rank_differences():
    class Row:
        def __init__(self, lang, gram, place):
            self.lang, self.gram, self.place = lang, gram, place

    keys, counts = langid.grams("abc abd")
    mine = langid.ranked(keys, counts, 400)
    rows = [Row("x", int(g), n + 1) for n, g in enumerate(mine)] + [Row("y", int(g), n + 1) for n, g in enumerate(mine[::-1])]
    assert langid.Profiles(rows, 400).best("abc abd") == ("x", 1.0)
    assert langid.Profiles([r for r in rows if r.lang == "y"], 400).best("abc abd")[1] == 1 - sum(abs(2 * k - len(mine) + 1) for k in range(len(mine))) / 400 / len(mine)


def test_texts_without_letters_and_tables_without_rows(spark):
    rows, docs = messy(spark)
    profiles = langid.learn_profiles(docs)
    got = {r.doc_id: r for r in langid.identify(docs, profiles).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        letters = any(c.isalpha() for c in t or "")
        assert (got[i].lang_pred in ("en", "de")) == letters and (got[i].lang_pred == "und") != letters
        assert 0 <= got[i].score <= 1
    kept = langid.without_unknown(docs, profiles)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t in rows if any(c.isalpha() for c in t or ""))
    none = docs.filter("false")
    assert {r.lang_pred for r in langid.identify(docs, langid.learn_profiles(none)).collect()} == {"und"}
    assert langid.identify(none, profiles).collect() == []


def test_ties_go_to_the_first_language(spark):
    docs = frame(spark, [(1, "aa bb"), (2, "aa bb")]).selectExpr("doc_id", "text", "if(doc_id = 1, 'z', 'k') AS lang")
    assert {r.lang_pred for r in langid.identify(docs, langid.learn_profiles(docs)).collect()} == {"k"}


def test_the_stage_keeps_texts_when_no_profile_is_learned(spark):
    from snapledger.llm.pipeline import keep_known_languages

    rows, docs = messy(spark)
    docs = docs.selectExpr(*[c if c != "lang" else "cast(NULL AS string) AS lang" for c in docs.columns])
    kept = keep_known_languages(spark, docs, "")
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(i for i, t in rows if any(c.isalpha() for c in t or ""))
