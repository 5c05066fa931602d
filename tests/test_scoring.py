import random
import re

import pytest
from pyspark.sql import functions as F

from voxlake.functions import sentiment as S
from voxlake.functions import text as X
from voxlake.operators import scoring

TEXTS = [
    "Amazing phone awesome camera 🔥",
    "Worst overpriced device",
    "not good at all, never bad",
    "Don’t love it ❤️",
    "",
    None,
    "class trash scam 😡😡",
    "no no good",
    "isn't   awful; good-bad",
    "goodness badly mid",
]


def brute_force(text, lexicon):
    text = text or ""
    tokens = re.findall(r"[a-zA-Z']+", text.lower().replace("’", "'"))
    up = down = 0
    for i, token in enumerate(tokens):
        negated = i > 0 and tokens[i - 1] in set(lexicon.negations)
        for words, sign in ((lexicon.positive, 1), (lexicon.negative, -1)):
            if token in set(words):
                if (sign == 1) != negated:
                    up += 1
                else:
                    down += 1
    up += sum(e in text for e in lexicon.positive_emojis)
    down += sum(e in text for e in lexicon.negative_emojis)
    return up, down, len(tokens)


def check(spark, texts, lexicon):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, comment_text string")
    for row in scoring.score_with_lexicon(df, lexicon).collect():
        up, down, count = brute_force(texts[row["i"]], lexicon)
        score = (up - down) / max(count, 1)
        label = "positive" if score > lexicon.threshold else "negative" if score < -lexicon.threshold else "neutral"
        got = (row["positive_hits"], row["negative_hits"], row["token_count"], row["sentiment_label"])
        assert got == (up, down, count, label), texts[row["i"]]
        assert row["sentiment_score"] == pytest.approx(score, abs=5.1e-5)


def test_lexicon_equals_brute_force(spark):
    check(spark, TEXTS, S.Lexicon())


def test_lexicon_on_random_texts_with_overlapping_sets(spark):
    rng = random.Random(3)
    words = "no not good bad best class it's x good's no-good never".split()
    texts = ["".join(rng.choice(words) + rng.choice([" ", "  ", ", ", "-", "'"]) for _ in range(12)) for _ in range(80)]
    check(spark, texts, S.Lexicon(positive=("good", "no"), negative=("bad", "no", "it's"), negations=("no", "not", "bad")))


def test_empty_lexicon(spark):
    check(spark, TEXTS, S.Lexicon((), (), (), (), ()))


def test_reference_labels(spark):
    df = spark.createDataFrame([(0, TEXTS[0]), (1, TEXTS[1])], "i int, comment_text string")
    labels = {r["i"]: r["sentiment_label"] for r in scoring.score_with_lexicon(df).collect()}
    assert labels == {0: "positive", 1: "negative"}


def enrichable(spark, texts):
    rows = [{**dict.fromkeys(scoring.REQUIRED, "x"), "comment_id": f"c{i}", "comment_text": t, "comment_like_count": "7",
             "reply_count": "bad"} for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, ", ".join(f"{c} string" for c in scoring.REQUIRED))


def test_classifier_scores_hits_and_blank_text(spark, rows):
    known = {
        TEXTS[0]: [("positive", 0.92), ("neutral", 0.05), ("negative", 0.03)],
        TEXTS[1]: [("LABEL_2", 0.04), ("LABEL_1", 0.08), ("LABEL_0", 0.88)],
    }

    def two_texts_scorer():
        return lambda batch: [[{"label": name, "score": s} for name, s in known[text]] for text in batch]

    df = enrichable(spark, [TEXTS[0], TEXTS[1], "  ", None])
    a, b, c, d = rows(scoring.enrich_sentiment(df, two_texts_scorer, "m", batch_size=1), "comment_id")
    assert (a["sentiment_label"], a["positive_hits"], a["sentiment_confidence"]) == ("positive", 92, 0.92)
    assert (b["sentiment_label"], b["negative_hits"], b["sentiment_score"]) == ("negative", 88, -0.84)
    for blank in (c, d):
        assert (blank["sentiment_label"], blank["sentiment_confidence"], blank["token_count"]) == ("neutral", 1.0, 0)
    assert (a["comment_like_count"], a["reply_count"], a["language_target"]) == (7, 0, "unknown")


def test_enrichment_scores_each_comment_once_and_needs_its_columns(spark):
    df = enrichable(spark, ["good", "bad"])
    assert scoring.enrich_sentiment(df.union(df)).count() == 2
    with pytest.raises(ValueError, match="comment_text"):
        scoring.enrich_sentiment(df.drop("comment_text"))


def test_keyword_tokens(spark):
    df = spark.createDataFrame([("The BEST phone-2024 ever, 123 ab héllo phone!",), (None,)], "t string")
    got = [r[0] for r in df.select(X.keyword_tokens(F.col("t"))).collect()]
    assert got == [["phone", "ever", "llo", "phone"], []]


@pytest.mark.parametrize("words", [["a", "ab", "abc", "b"], ["don't", "dont"], []])
def test_word_pattern_matches_exactly_its_words(words):
    pattern = re.compile(f"^(?:{S.word_pattern(words)})$")
    for probe in ["", "a", "ab", "abc", "abcd", "b", "dont", "don't", "d"]:
        assert bool(pattern.match(probe)) == (probe in words)


def test_a_text_is_scanned_once(spark):
    """Tokens are made by one expression, not again for each side, and match the brute force next to negations."""
    texts = ["no no good bad", "not bad, never good 👍", "good " * 40, "gut 🔥 größe", "don't don't love hate"]
    check(spark, texts, S.Lexicon())
    df = spark.createDataFrame([("good",)], "comment_text string")
    plan = scoring.score_with_lexicon(df)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1
