"""Registered queries for text functions and text features."""

from __future__ import annotations

from pyspark.sql import functions as F

from quarry.functions import text as T
from quarry.functions.numeric import hash_unit, logistic, softmax
from quarry.operators import features as X
from quarry.operators.classify import multinomial_nb_fit, multinomial_nb_scores, top_classes
from quarry.operators.evaluate import perplexity
from quarry.plans.registry import SIG, register
from quarry.plans.sqlhelp import sql_hash_unit
from quarry.session import table
from quarry.sources.files import materialize, scratch_path


def _sql_str_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


STOP_SQL = _sql_str_list(T.STOP_WORDS)
WS_SQL = "'[ \\t\\n\\r\\f]+'"
PUNCT_SQL = "'" + T.PUNCTUATION.replace("'", "''") + "'"


def _sql_split_words(e: str) -> str:
    return f"list_filter(regexp_split_to_array({e}, {WS_SQL}), lambda w: w <> '')"


def _sql_basic_tokens(col: str) -> str:
    e = f"lower({col})"
    for pat, rep in T.BASIC_TOKEN_RULES:
        pat_sql = pat.replace("'", "''")
        rep_sql = rep.replace("'", "''")
        e = f"regexp_replace({e}, '{pat_sql}', '{rep_sql}', 'g')"
    return _sql_split_words(e)


def _sql_word_tokens(col: str) -> str:
    return (f"list_filter(regexp_extract_all(lower({col}), '[\\p{{L}}\\p{{N}}_]{{2,}}'), "
            f"lambda x: NOT list_contains({STOP_SQL}, x))")


@register("strip_punctuation_documents", f"""
SELECT doc_id, translate(text, {PUNCT_SQL}, '') AS text FROM documents
""")
def strip_punctuation_documents(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", T.strip_punctuation("text").alias("text"))


@register("remove_stopwords_documents", f"""
SELECT doc_id, array_to_string(list_filter({_sql_split_words("translate(text, " + PUNCT_SQL + ", '')")},
                                           lambda w: NOT list_contains({STOP_SQL}, lower(w))), ' ') AS text
FROM documents
""")
def remove_stopwords_documents(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", T.remove_stopwords(T.strip_punctuation("text")).alias("text"))


@register("fold_to_ascii_documents", f"""
SELECT doc_id, regexp_replace(strip_accents(text), '[^{T.ALLOWED_LETTERS.replace("'", "''")}]', '', 'g') AS text
FROM documents
""")
def fold_to_ascii_documents(spark, sf):
    d = table(spark, sf, "documents")
    return d.select("doc_id", T.fold_to_ascii("text").alias("text"))


@register("char_index_part_names", f"""
SELECT p_partkey, CAST(i - 1 AS INTEGER) AS pos, substring(p_name, i, 1) AS ch,
       CAST(strpos('{T.ALLOWED_LETTERS.replace("'", "''")}', substring(p_name, i, 1)) - 1 AS INTEGER) AS idx
FROM part, range(1, length(p_name) + 1) r(i)
""")
def char_index_part_names(spark, sf):
    p = table(spark, sf, "part")
    chars = F.filter(F.split("p_name", ""), lambda c: c != "")
    z = F.arrays_zip(chars.alias("ch"), T.char_index("p_name").alias("idx"))
    return p.select("p_partkey", F.posexplode(z).alias("pos", "_z")).select(
        "p_partkey", "pos", F.col("_z.ch").alias("ch"), F.col("_z.idx").alias("idx"))


@register("basic_tokens_documents", f"""
SELECT doc_id, CAST(len(toks) AS INTEGER) AS n_tokens, array_to_string(toks, ' ') AS tokens
FROM (SELECT doc_id, {_sql_basic_tokens('text')} AS toks FROM documents)
""")
def basic_tokens_documents(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", T.basic_tokens("text").alias("toks"))
    return d.select("doc_id", F.size("toks").alias("n_tokens"), F.array_join("toks", " ").alias("tokens"))


@register("logistic_lineitem", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_discount * 20 - 1 AS z,
       1.0 / (1.0 + exp(-(l_discount * 20 - 1))) AS p FROM lineitem
""", {"z": 9, "p": SIG})
def logistic_lineitem(spark, sf):
    li = table(spark, sf, "lineitem")
    z = F.col("l_discount") * 20 - 1
    return li.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", z.alias("z"),
                     logistic(z).alias("p"))


@register("softmax_events_per_user", """
SELECT event_id, user_id, value, exp(value - mx) / sum(exp(value - mx)) OVER (PARTITION BY user_id) AS softmax
FROM (SELECT event_id, user_id, value, max(value) OVER (PARTITION BY user_id) AS mx FROM events)
""", {"softmax": SIG})
def softmax_events_per_user(spark, sf):
    ev = table(spark, sf, "events").select("event_id", "user_id", "value")
    return softmax(ev, ["user_id"], "value")


# ------------------------------------------------------------------ TF-IDF

_DOC_SPLIT = f"CASE WHEN {sql_hash_unit(42, ['doc_id'])} < 0.85 THEN 'train' ELSE 'test' END"

_TERMS_SQL = f"""
d AS (SELECT doc_id, {_DOC_SPLIT} AS part, text FROM documents),
t AS (SELECT doc_id, part, unnest({_sql_word_tokens('text')}) AS term FROM d),
n AS (SELECT count(DISTINCT doc_id) AS n FROM t WHERE part = 'train'),
dfreq AS (SELECT term, count(DISTINCT doc_id) AS df FROM t WHERE part = 'train' GROUP BY term),
idf AS (SELECT term, ln((1.0 + n) / (1.0 + df)) + 1.0 AS idf FROM dfreq, n)
"""


def split_documents(spark, sf):
    d = table(spark, sf, "documents")
    return d.withColumn("part", F.when(hash_unit(42, ["doc_id"]) < 0.85, "train").otherwise("test"))


def document_terms(spark, sf):
    """(doc_id, part, terms, tfs), counted once for all that follows."""
    return X.term_lists(split_documents(spark, sf), ["doc_id", "part"], "text")


@register("tfidf_test_documents", f"""
WITH {_TERMS_SQL},
tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE part = 'test' GROUP BY ALL),
w AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term))
SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w
""", {"weight": SIG})
def tfidf_test_documents(spark, sf):
    t = document_terms(spark, sf)
    return X.tfidf(t.where("part = 'train'"), t.where("part = 'test'"), "doc_id")


@register("bag_of_words_documents", f"""
WITH {_TERMS_SQL}
SELECT doc_id, term, count(*) AS tf FROM t GROUP BY ALL
""")
def bag_of_words_documents(spark, sf):
    return X.term_counts(table(spark, sf, "documents"), ["doc_id"], "text")


@register("feature_summary_tfidf", f"""
WITH {_TERMS_SQL},
tf AS (SELECT doc_id, term, count(*) AS tf FROM t WHERE part = 'train' GROUP BY ALL),
w0 AS (SELECT doc_id, term, tf * idf AS w FROM tf JOIN idf USING (term)),
w AS (SELECT doc_id, term, w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)) AS weight FROM w0),
g AS (SELECT term, count(*) AS nnz, sum(weight) AS s, sum(weight * weight) AS ss, min(weight) AS mn,
             max(weight) AS mx FROM w GROUP BY term),
mom AS (
  SELECT term, 'count' AS stat, CAST(n AS DOUBLE) AS value FROM g, n
  UNION ALL SELECT term, 'mean', s / n FROM g, n
  UNION ALL SELECT term, 'std', sqrt(greatest((ss - s * s / n) / (n - 1), 0.0)) FROM g, n
  UNION ALL SELECT term, 'min', CASE WHEN n - nnz > 0 THEN least(mn, 0.0) ELSE mn END FROM g, n
  UNION ALL SELECT term, 'max', CASE WHEN n - nnz > 0 THEN greatest(mx, 0.0) ELSE mx END FROM g, n),
ranked AS (SELECT term, weight, row_number() OVER (PARTITION BY term ORDER BY weight) - 1 AS r FROM w),
tg AS (SELECT term, p, n - nnz AS z, floor((n - 1) * p) AS lo, ceil((n - 1) * p) AS hi,
              (n - 1) * p - floor((n - 1) * p) AS frac
       FROM g, n, (SELECT unnest([0.25, 0.5, 0.75]) AS p)),
q AS (SELECT tg.term, tg.p,
             CASE WHEN tg.lo < tg.z THEN 0.0 ELSE rl.weight END AS vlo,
             CASE WHEN tg.hi < tg.z THEN 0.0 ELSE rh.weight END AS vhi, frac
      FROM tg LEFT JOIN ranked rl ON rl.term = tg.term AND rl.r = tg.lo - tg.z
              LEFT JOIN ranked rh ON rh.term = tg.term AND rh.r = tg.hi - tg.z)
SELECT * FROM mom
UNION ALL
SELECT term, CAST(CAST(p * 100 AS INTEGER) AS VARCHAR) || '%', vlo + frac * (vhi - vlo) FROM q
""", {"value": SIG})
def feature_summary_tfidf(spark, sf):
    t = document_terms(spark, sf).where("part = 'train'")
    w = X.tfidf(t, t, "doc_id")
    return X.feature_summary(w, "doc_id")


@register("vocabulary_documents", f"""
WITH tok AS (SELECT unnest({_sql_basic_tokens('text')}) AS token FROM documents),
c AS (SELECT token, count(*) AS n FROM tok WHERE token <> '<unk>' GROUP BY token)
SELECT '<unk>' AS token, CAST(0 AS BIGINT) AS id, CAST(0 AS BIGINT) AS n
UNION ALL
SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id, n FROM c
""")
def vocabulary_documents(spark, sf):
    d = table(spark, sf, "documents")
    tok = d.select(F.explode(T.basic_tokens("text")).alias("token"))
    return X.vocabulary(tok)


@register("numericalise_documents", f"""
WITH d AS (SELECT doc_id, {_DOC_SPLIT} AS part, text FROM documents),
tok AS (SELECT doc_id, part, unnest({_sql_basic_tokens('text')}) AS token,
               CAST(generate_subscripts({_sql_basic_tokens('text')}, 1) - 1 AS INTEGER) AS pos FROM d),
c AS (SELECT token, count(*) AS n FROM tok WHERE part = 'train' AND token <> '<unk>' GROUP BY token),
v AS (SELECT token, row_number() OVER (ORDER BY n DESC, token) AS id FROM c)
SELECT tok.doc_id, tok.pos, tok.token, CAST(coalesce(v.id, 0) AS BIGINT) AS token_id
FROM tok LEFT JOIN v USING (token) WHERE tok.part = 'test'
""")
def numericalise_documents(spark, sf):
    tok = split_documents(spark, sf).select("doc_id", "part", F.posexplode(T.basic_tokens("text")).alias("pos", "token"))
    vocab = X.vocabulary(tok.where("part = 'train'"))
    return X.numericalise(tok.where("part = 'test'"), vocab).select("doc_id", "pos", "token", "token_id")


@register("char_ngrams_by_language", """
WITH ch AS (SELECT doc_id, lang, unnest(string_split(text, '')) AS c,
                   generate_subscripts(string_split(text, ''), 1) AS i FROM documents),
g AS (SELECT lang, c || lead(c, 1) OVER w || lead(c, 2) OVER w AS gram
      FROM ch WINDOW w AS (PARTITION BY doc_id ORDER BY i))
SELECT lang, gram, count(*) AS count FROM g WHERE gram IS NOT NULL GROUP BY ALL
""")
def char_ngrams_by_language(spark, sf):
    d = table(spark, sf, "documents")
    return X.char_ngrams(d, ["lang"], "text", 3)


@register("class_weights_quality", """
SELECT quality, count(*) AS n_c, (SELECT count(*) FROM labels) / ((SELECT count(DISTINCT quality) FROM labels)
       * CAST(count(*) AS DOUBLE)) AS class_weight
FROM labels GROUP BY quality
""", {"class_weight": SIG})
def class_weights_quality(spark, sf):
    return X.class_weights(table(spark, sf, "labels"), "quality")


# ------------------------------------------------- language of a text

_GRAMS_SQL = f"""
d AS (SELECT doc_id, lang, {_DOC_SPLIT} AS part, text FROM documents),
ch AS (SELECT doc_id, lang, part, unnest(string_split(text, '')) AS c,
              generate_subscripts(string_split(text, ''), 1) AS i FROM d),
gr AS (SELECT * FROM (SELECT doc_id, lang, part, c || lead(c, 1) OVER w || lead(c, 2) OVER w AS term
                      FROM ch WINDOW w AS (PARTITION BY doc_id ORDER BY i)) WHERE term IS NOT NULL),
tw AS (SELECT doc_id, lang, part, term, CAST(count(*) AS DOUBLE) AS weight FROM gr GROUP BY ALL),
train AS (SELECT * FROM tw WHERE part = 'train'),
vocab AS (SELECT DISTINCT term FROM train),
V AS (SELECT count(*) AS v FROM vocab),
nd AS (SELECT count(DISTINCT doc_id) AS n FROM train),
pri AS (SELECT lang AS label, ln(count(DISTINCT doc_id) / (SELECT n FROM nd)) AS lp,
               ln(1.0 / (sum(weight) + (SELECT v FROM V))) AS lu FROM train GROUP BY lang),
seen AS (SELECT lang AS label, term, ln(sum(weight) + 1.0) - ln(1.0) AS delta FROM train GROUP BY ALL),
test AS (SELECT tw.* FROM tw JOIN vocab USING (term) WHERE part = 'test'),
W AS (SELECT doc_id, sum(weight) AS W FROM test GROUP BY doc_id),
base AS (SELECT doc_id, label, lp + W * lu AS b FROM W, pri),
corr AS (SELECT doc_id, label, sum(weight * delta) AS c FROM test JOIN seen USING (term) GROUP BY ALL),
sc AS (SELECT base.doc_id, base.label, b + coalesce(c, 0.0) AS score
       FROM base LEFT JOIN corr ON base.doc_id = corr.doc_id AND base.label = corr.label),
sm AS (SELECT *, max(score) OVER (PARTITION BY doc_id) AS mx FROM sc),
lp AS (SELECT doc_id, label, score,
              score - (mx + ln(sum(exp(score - mx)) OVER (PARTITION BY doc_id))) AS log_prob FROM sm)
"""


def _lang_scores(spark, sf):
    d = split_documents(spark, sf)
    # doc_id is the documents table's key: one row per document
    grams = X.char_ngrams(d, ["doc_id", "lang", "part"], "text", 3, name="term", unique_rows=True)
    # the model and the scoring read these counts about ten times: write them
    # once to the shared checkpoint folder instead of recounting every time
    path = scratch_path(spark, "lang-grams")
    grams.select("doc_id", "lang", "part", "term", F.col("count").cast("double").alias("weight")) \
        .write.parquet(path)
    tw = spark.read.parquet(path)
    model = multinomial_nb_fit(tw.where("part = 'train'"), "doc_id", "lang", alpha=1.0)
    return multinomial_nb_scores(model, tw.where("part = 'test'"), "doc_id")


@register("classify_language_top3", f"""
WITH {_GRAMS_SQL}
SELECT doc_id, CAST(rank AS INTEGER) AS rank, label, log_prob FROM (
  SELECT doc_id, label, log_prob, row_number() OVER (PARTITION BY doc_id ORDER BY score DESC, label) AS rank
  FROM lp) WHERE rank <= 3
""", {"log_prob": SIG})
def classify_language_top3(spark, sf):
    return top_classes(_lang_scores(spark, sf), "doc_id", 3)


# ---------------------------------------------- unigram perplexity

_UNIGRAM_SQL = f"""
d AS (SELECT doc_id, lang, {_DOC_SPLIT} AS part, text FROM documents),
tok AS (SELECT doc_id, lang, part, unnest({_sql_basic_tokens('text')}) AS token FROM d),
c AS (SELECT token, count(*) AS n FROM tok WHERE part = 'train' AND token <> '<unk>' GROUP BY token),
tot AS (SELECT sum(n) AS N, count(*) + 1 AS V FROM c),
ev AS (SELECT tok.doc_id, tok.lang, -ln((coalesce(c.n, 0) + 1.0) / (tot.N + tot.V)) AS nll
       FROM tok LEFT JOIN c USING (token), tot WHERE tok.part = 'test'),
seg AS (SELECT doc_id, lang, avg(nll) AS mean_loss, count(*) AS n_tokens FROM ev GROUP BY ALL)
"""


def unigram_losses(spark, sf):
    """Per held-out document: mean negative log-likelihood under an add-one
    unigram model of the training documents, and its token count."""
    d = split_documents(spark, sf)
    tok = d.select("doc_id", "lang", "part", F.explode(T.basic_tokens("text")).alias("token"))
    # the training documents are only needed as one count a token, added up in the tasks before the shuffle
    vocab = materialize(tok.where("part = 'train'").where(F.col("token") != "<unk>")
                        .groupBy("token").agg(F.count(F.lit(1)).alias("n")), "unigrams")
    N, V = vocab.select(F.sum("n")).scalar(), vocab.select(F.count(F.lit(1)) + 1).scalar()
    counts = materialize(tok.where("part = 'test'").groupBy("doc_id", "lang", "token")
                         .agg(F.count(F.lit(1)).alias("k")), "token-counts")
    ev = X.join_terms(counts, vocab, "token", -F.col("n"), "left").withColumn(
        "nll", -F.ln((F.coalesce("n", F.lit(0)) + 1.0) / (N + V)))
    return ev.groupBy("doc_id", "lang").agg((F.sum(F.col("k") * F.col("nll")) / F.sum("k")).alias("mean_loss"),
                                            F.sum("k").alias("n_tokens"))


@register("unigram_perplexity_documents", f"""
WITH {_UNIGRAM_SQL}
SELECT sum(mean_loss * n_tokens) / sum(n_tokens) AS mean_loss,
       exp(sum(mean_loss * n_tokens) / sum(n_tokens)) AS perplexity FROM seg
""", {"mean_loss": SIG, "perplexity": SIG})
def unigram_perplexity_documents(spark, sf):
    return perplexity(unigram_losses(spark, sf), "mean_loss", "n_tokens")


@register("perplexity_by_language", f"""
WITH {_UNIGRAM_SQL}
SELECT lang, sum(mean_loss * n_tokens) / sum(n_tokens) AS mean_loss,
       exp(sum(mean_loss * n_tokens) / sum(n_tokens)) AS perplexity FROM seg GROUP BY lang
""", {"mean_loss": SIG, "perplexity": SIG})
def perplexity_by_language(spark, sf):
    return perplexity(unigram_losses(spark, sf), "mean_loss", "n_tokens", by=["lang"])
