"""Property tests: the Spark text operators against a direct Python model
of the reference semantics (str.split on '.' and ' ', str.isalpha)."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tallyho.operators import text as T

ALPHABET = "abcXYZéÀß' .,!?-1 2\n\t."
lines_st = st.lists(st.text(alphabet=ALPHABET, max_size=30), min_size=1, max_size=6)


def _strip_token(tok):
    # leading / trailing non-letters removed; a token without letters vanishes
    letters = [i for i, ch in enumerate(tok) if ch.isalpha()]
    return tok[letters[0]:letters[-1] + 1] if letters else ""


def _strip_line(toks):
    alpha = [t.isalpha() for t in toks]
    if True not in alpha:
        return toks if len(toks) == 1 else []
    first = alpha.index(True)
    last = len(alpha) - 1 - alpha[::-1].index(True)
    return toks[first:last + 1]


def _model(texts):
    sents = words = 0
    tok_counts, line_counts = Counter(), Counter()
    for text in texts:
        for line in text.split("\n"):
            sents += len([p for p in line.split(".") if p])
            words += len([p for p in line.split(" ") if p])
            toks = line.lower().split(" ")
            tok_counts.update(w for w in (_strip_token(t) for t in toks) if w)
            line_counts.update(t for t in _strip_line(toks) if t)
    return sents, words, tok_counts, line_counts


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(texts=lines_st)
def test_text_operators_match_python_model(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "text STRING")
    sents, words, tok_counts, line_counts = _model(texts)
    assert T.sentence_count(df).first()["n_sentences"] == sents
    assert T.word_count(df).first()["n_words"] == words
    assert {r["word"]: r["n"] for r in T.word_counts(df).collect()} == dict(tok_counts)
    assert {r["word"]: r["n"] for r in T.word_counts(df, strip="line").collect()} == dict(line_counts)
    easy = spark.createDataFrame([("abc",)], "word STRING")
    dc = T.dale_chall(df, easy).first()
    assert (dc["n_sentences"], dc["n_words"]) == (sents, words)
    assert dc["n_difficult"] == len([w for w in tok_counts if w != "abc"])
