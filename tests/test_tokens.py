"""Tokens, n-grams, compounds, kwic and the "joke" sentence."""

from pyspark.sql import functions as F

from quire.operators import dfm as D
from quire.operators import tokens as T

JOKE = "If that is a joke, I love it. If not, can't wait to unpack that with you later."


def _docs(spark, *texts):
    return spark.createDataFrame([(i + 1, t) for i, t in enumerate(texts)], "doc_id long, text string")


def test_joke_sentence_features(spark):
    d = D.dfm(T.unnest_tokens(_docs(spark, JOKE)))
    got = {r.term: r.n for r in d.collect()}
    assert len(got) == 16
    assert got["if"] == 2 and got["that"] == 2 and got["can't"] == 1
    assert sum(got.values()) == 18


def test_tokens_keep_punct_and_remove_flags(spark):
    docs = _docs(spark, "Hello, world! 42 times $5 http://x.org/a")
    t = T.tokens(docs)
    terms = [r.term for r in t.orderBy("pos").collect()]
    assert terms == ["Hello", ",", "world", "!", "42", "times", "$", "5", "http://x.org/a"]
    t2 = T.tokens(docs, remove_punct=True, remove_numbers=True, remove_symbols=True, remove_url=True)
    kept = [(r.pos, r.term) for r in t2.orderBy("pos").collect()]
    assert kept == [(1, "Hello"), (3, "world"), (6, "times")]  # positions keep pads


def test_sentences(spark):
    s = T.unnest_sentences(_docs(spark, "One two. Three four! Five?  Six"), lower=False)
    assert [r.sentence for r in s.orderBy("pos").collect()] == ["One two.", "Three four!", "Five?", "Six"]


def test_ngrams_and_short_docs(spark):
    g = T.unnest_ngrams(_docs(spark, "a b c d", "x"), 3)
    rows = [(r.doc_id, r.pos, r.ngram) for r in g.orderBy("doc_id", "pos").collect()]
    assert rows == [(1, 1, "a b c"), (1, 2, "b c d")]


def test_tokens_ngrams_mixed_sizes(spark):
    arr = T.token_arrays(_docs(spark, "a b c"))
    out = T.tokens_ngrams(arr, [1, 2]).first().toks
    assert out == ["a", "b", "c", "a_b", "b_c"]


def test_compound_longest_first(spark):
    arr = T.token_arrays(_docs(spark, "new york city is in new york state"))
    out = T.tokens_compound(arr, ["new york", "new york city"]).first().toks
    assert out == ["new_york_city", "is", "in", "new_york", "state"]


def test_kwic(spark):
    t = T.token_arrays(_docs(spark, "one two three key four five six"))
    k = T.kwic(t, "^key$", window=2).first()
    assert (k.pos, k.keyword, k.pre, k.post) == (4, "key", "two three", "four five")
    edges = [(r.pos, r.pre, r.post) for r in T.kwic(T.token_arrays(_docs(spark, "key b key")), "^key$", 5).orderBy("pos").collect()]
    assert edges == [(1, "", "b key"), (3, "key b", "")]


def test_stopwords_and_select_keep_positions(spark):
    t = T.unnest_tokens(_docs(spark, "the cat and the dog"))
    kept = T.remove_stopwords(t)
    assert [(r.pos, r.term) for r in kept.orderBy("pos").collect()] == [(2, "cat"), (5, "dog")]
    sel = T.tokens_select(t, ["dog", "the"])
    assert [r.pos for r in sel.orderBy("pos").collect()] == [1, 4, 5]


def test_collocations_scores(spark):
    arr = T.token_arrays(_docs(spark, "new york is big new york is old", "a new car"))
    c = {r.collocation: r for r in T.collocations(arr, min_count=2).collect()}
    r = c["new york"]
    # 2x2 table: n11=2, n12=1 ("new car"), n21=0, n22=N-3 with N=9 bigrams
    import math
    a, b, cc, d = 2.5, 1.5, 0.5, 9 - 3 + 0.5
    lam = math.log(a * d / (b * cc))
    assert r["count"] == 2
    assert abs(r["lambda"] - lam) < 1e-9
    assert abs(r.z - lam / math.sqrt(1 / a + 1 / b + 1 / cc + 1 / d)) < 1e-9


def test_strip_html(spark):
    df = spark.createDataFrame([("<html><script>var a='<p>';</script><p>Hi &amp; bye</p><!-- c --></html>",)], "html string")
    assert T.strip_html_table(df).first().text == "Hi & bye"


def test_lemmatize(spark):
    t = T.unnest_tokens(_docs(spark, "cats ran"))
    lm = spark.createDataFrame([("cats", "cat")], "term string, lemma string")
    assert sorted(r.term for r in T.lemmatize(t, lm).collect()) == ["cat", "ran"]


def test_skipgram_half_matches_full(spark):
    from quire.operators import embeddings as E
    arr = T.token_arrays(_docs(spark, "a b a c d e f a b", "x y z x y z x"))
    full = {(r.term1, r.term2): r.n for r in E.skipgram_pairs(arr, 3).collect()}
    both = {(r.term1, r.term2): r.n for r in E.mirror_pairs(E.skipgram_pairs_half(arr, 3)).collect()}
    assert full == both
    assert full[("a", "a")] == 5  # windows holding "a" (5 of the 7)


def test_skipgram_pmi_hashed_equals_string_path(spark):
    from quire.operators import dfm as D
    from quire.operators import embeddings as E
    texts = ["a b c a b c d e a b", "b c d e f a b c", "a a b b c c d d"]
    arr = T.token_arrays(_docs(spark, *texts))
    fast = {(r.term1, r.term2): (r.n, round(r.pmi, 9)) for r in E.skipgram_pmi(arr, 3, 1).collect()}
    uni = E.unigram_probs(D.dfm_from_arrays(arr))
    slow = {(r.term1, r.term2): (r.n, round(r.pmi, 9)) for r in E.pmi_table(E.skipgram_pairs(arr, 3), uni, 1).collect()}
    assert fast == slow and len(fast) > 5
