"""Registered queries: scalar / text functions (H1-H27) and text mining."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, CountVectorizerModel, HashingTF, RegexTokenizer, StopWordsRemover, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from tadkit.functions import dates as dt
from tadkit.functions import numeric as nu
from tadkit.functions import strings as sx
from tadkit.functions import text as tx
from tadkit.operators import textmining as tm
from tadkit.operators.frame import spread
from tadkit.operators.segment import kmeans, knn_exact
from tadkit.plans.registry import query
from tadkit.session import Tables, scratch_path, written

_TOK_SQL = "list_filter(regexp_split_to_array(lower({c}), '[^\\p{{L}}\\p{{N}}]+'), lambda t: length(t) > 0)"


def tok_sql(c: str) -> str:
    return _TOK_SQL.format(c=c)


# ---------------------------------------------------------------- H ------------
@query("h1_trim_blanks_quotes", """
SELECT c_custkey, trim('  ''' || c_name || '''  ') AS quoted, trim(trim('  ''' || c_name || '''  '), '''"') AS unquoted
FROM customer""")
def h1_trim(spark, d):
    c = Tables(spark, d).customer
    raw = F.concat(F.lit("  '"), F.col("c_name"), F.lit("'  "))
    return c.select("c_custkey", sx.strip(raw).alias("quoted"), sx.strip_quotes(raw).alias("unquoted"))


@query("h2_split_take_part", """
SELECT page_id, split_part(url, '/', 3) AS host, split_part(split_part(url, '/', 3), '.', 1) AS sub,
       split_part(url, '?', 2) AS query_string FROM pages""")
def h2_split(spark, d):
    p = Tables(spark, d).pages
    return p.select("page_id", sx.split_take("url", "/", 2).alias("host"),
                    sx.split_take(sx.split_take("url", "/", 2), ".", 0).alias("sub"),
                    sx.split_take("url", "?", 1).alias("query_string"))


@query("h3_substring_positions", """
SELECT o_orderkey, CAST(substr(CAST(o_orderdate AS VARCHAR), 1, 4) AS INTEGER) AS yr,
       CAST(substr(CAST(o_orderdate AS VARCHAR), 6, 2) AS INTEGER) AS mo,
       CAST(substr(CAST(o_orderdate AS VARCHAR), 9, 2) AS INTEGER) AS dy FROM orders""")
def h3_substr(spark, d):
    o = Tables(spark, d).orders.withColumn("s", F.col("o_orderdate").cast("string"))
    return o.select("o_orderkey", sx.substr("s", 1, 4).cast("int").alias("yr"), sx.substr("s", 6, 2).cast("int").alias("mo"),
                    sx.substr("s", 9, 2).cast("int").alias("dy"))


@query("h4_case_functions", """
SELECT n_nationkey, lower(n_name) AS lo, upper(lower(n_name)) AS up,
       upper(substr(n_name, 1, 1)) || lower(substr(n_name, 2)) AS cap FROM nation""")
def h4_case(spark, d):
    n = Tables(spark, d).nation
    return n.select("n_nationkey", F.lower("n_name").alias("lo"), F.upper(F.lower("n_name")).alias("up"),
                    sx.capitalize("n_name").alias("cap"))


@query("h5_zero_pad_codes", """
SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 5, '0') AS nation5, lpad(CAST(c_custkey % 10000 AS VARCHAR), 4, '0') AS cust4
FROM customer""")
def h5_pad(spark, d):
    c = Tables(spark, d).customer
    return c.select("c_custkey", sx.zero_pad("c_nationkey", 5).alias("nation5"),
                    sx.zero_pad(F.col("c_custkey") % 10000, 4).alias("cust4"))


@query("h6_first_character_code", """
SELECT c_mktsegment AS seg, substr(c_mktsegment, 1, 1) AS code, count(*) AS n FROM customer GROUP BY 1, 2""")
def h6_first(spark, d):
    c = Tables(spark, d).customer
    return c.groupBy(F.col("c_mktsegment").alias("seg"), sx.first_char("c_mktsegment").alias("code")).agg(
        F.count(F.lit(1)).alias("n"))


@query("h7_composite_key", """
SELECT o_orderkey, concat_ws('_', CAST(o_custkey AS VARCHAR), o_orderstatus, CAST(year(o_orderdate) AS VARCHAR)) AS ckey
FROM orders""")
def h7_key(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", sx.composite_key("o_custkey", "o_orderstatus", F.year("o_orderdate")).alias("ckey"))


@query("h8_parse_amount_units", """
SELECT l_orderkey, l_linenumber,
  TRY_CAST(regexp_replace('$' || CAST(l_extendedprice AS VARCHAR), '[^0-9.\\-]', '', 'g') AS DOUBLE) AS amount,
  CASE WHEN l_returnflag = 'R' THEN l_quantity * 1.4 ELSE l_quantity END AS converted
FROM lineitem""")
def h8_parse(spark, d):
    li = Tables(spark, d).lineitem
    txt = F.concat(F.lit("$"), F.col("l_extendedprice").cast("string"))
    unit = F.concat(F.col("l_quantity").cast("string"), F.lit(" "),
                    F.when(F.col("l_returnflag") == "R", F.lit("km/kg")).otherwise(F.lit("kmpl")))
    return li.select("l_orderkey", "l_linenumber", sx.parse_amount(txt).alias("amount"),
                     sx.unit_value(unit, {"km/kg": 1.4}).alias("converted"))


@query("h9_length_char_count", """
SELECT doc_id, CAST(length(text) AS INTEGER) AS n_chars, CAST(length(text) - length(replace(text, ',', '')) AS INTEGER) AS n_commas,
       CAST(length(text) - length(replace(text, chr(10), '')) AS INTEGER) AS n_lines FROM documents""")
def h9_len(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", F.length("text").alias("n_chars"), sx.char_count("text", ",").alias("n_commas"),
                       sx.char_count("text", "\n").alias("n_lines"))


@query("h10_regex_entity_counts", f"""
SELECT doc_id, CAST(len(regexp_extract_all(text, '{sx.URL_RE}')) AS INTEGER) AS n_urls,
       CAST(len(regexp_extract_all(text, '{sx.EMAIL_RE}')) AS INTEGER) AS n_emails,
       CAST(len(regexp_extract_all(text, '{sx.PHONE_RE}')) AS INTEGER) AS n_phones,
       CAST(CASE WHEN length(lang) > 0 THEN (length(lower(text)) - length(replace(lower(text), lower(lang), ''))) // length(lang)
            ELSE 0 END AS INTEGER) AS n_lang_code FROM documents""")
def h10_regex(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", sx.count_urls("text").alias("n_urls"), sx.count_emails("text").alias("n_emails"),
                       sx.count_phones("text").alias("n_phones"),
                       sx.count_literal_ci(F.lower("text"), F.lower("lang")).alias("n_lang_code"))


@query("h11_character_class_ratios", """
SELECT doc_id, CAST(length(regexp_replace(text, '[^\\p{Ll}]', '', 'g')) AS INTEGER) AS n_lower,
       CAST(length(regexp_replace(text, '[^\\p{Lu}]', '', 'g')) AS INTEGER) AS n_upper,
       round(coalesce(CASE WHEN length(regexp_replace(text, '[^\\p{L}]', '', 'g')) = 0 THEN NULL
             ELSE length(regexp_replace(text, '[^\\p{Lu}]', '', 'g')) / length(regexp_replace(text, '[^\\p{L}]', '', 'g')) END, 0.0), 9)
         AS upper_ratio FROM documents""")
def h11_classes(spark, d):
    docs = Tables(spark, d).documents
    return docs.select("doc_id", sx.count_class("text", r"\p{Ll}").alias("n_lower"),
                       sx.count_class("text", r"\p{Lu}").alias("n_upper"),
                       F.round(sx.class_ratio("text", r"\p{Lu}", over=r"\p{L}"), 9).alias("upper_ratio"))


@query("h12_emoji_count", f"""
SELECT conv_id, turn, CAST(len(regexp_extract_all(text, '{sx.EMOJI_RE}')) AS INTEGER) AS n_emoji FROM conversations""")
def h12_emoji(spark, d):
    c = Tables(spark, d).conversations
    return c.select("conv_id", "turn", sx.count_emoji("text").alias("n_emoji"))


@query("h13_clean_text", r"""
SELECT doc_id, trim(lower(regexp_replace(regexp_replace(strip_accents(text), '[^\x00-\x7F]+', '', 'g'), '[^A-Za-z0-9]+', ' ', 'g'))) AS clean
FROM documents""")
def h13_clean(spark, d):
    return Tables(spark, d).documents.select("doc_id", tx.clean_text("text").alias("clean"))


def _html_sql(c: str) -> str:
    s = f"regexp_replace({c}, '(?is)<script[^>]*>.*?</script\\s*>', ' ', 'g')"
    s = f"regexp_replace({s}, '(?is)<style[^>]*>.*?</style\\s*>', ' ', 'g')"
    s = f"regexp_replace({s}, '(?s)<!--.*?-->', ' ', 'g')"
    s = f"regexp_replace({s}, '<[^>]*>', ' ', 'g')"
    # The references that the pages hold; the ampersand last, so that nothing is decoded twice.
    for ent, code in (("&lt;", 60), ("&gt;", 62), ("&quot;", 34), ("&#39;", 39), ("&nbsp;", 160), ("&copy;", 169), ("&middot;", 183), ("&eacute;", 233), ("&amp;", 38)):
        s = f"replace({s}, '{ent}', chr({code}))"
    return f"trim(regexp_replace({s}, '[\\s\u00a0]+', ' ', 'g'))"


@query("h14_strip_html", f"SELECT page_id, {_html_sql('html')} AS visible FROM pages")
def h14_html(spark, d):
    return spread(Tables(spark, d).pages.select("page_id", "html")).select("page_id", tx.strip_html("html").alias("visible"))


@query("h15_punctuation_digits_quotes", f"""
SELECT doc_id, array_to_string(list_filter({tok_sql("regexp_replace(regexp_replace(text, '[''\"‘’“”]', ' ', 'g'), '[\\p{P}\\p{S}]', ' ', 'g')")},
  lambda t: NOT regexp_full_match(t, '[0-9]+')), ' ') AS cleaned FROM documents""")
def h15_punct(spark, d):
    docs = Tables(spark, d).documents
    s = tx.remove_punctuation(tx.remove_quotes("text"))
    return docs.select("doc_id", F.array_join(tx.drop_digit_tokens(tx.tokenize(s)), " ").alias("cleaned"))


_STOP = tx.stop_words(["english", "french", "german", "spanish"], extra=["eau"], remove=["not"])


def _sql_list(words) -> str:
    return "[" + ", ".join("'" + w.replace("'", "''") + "'" for w in words) + "]"


@query("h16_stop_word_removal", f"""
SELECT doc_id, CAST(len({tok_sql('text')}) AS INTEGER) AS n_tokens,
       CAST(len(list_filter({tok_sql('text')}, lambda t: NOT list_contains({_sql_list(_STOP)}, t))) AS INTEGER) AS n_kept FROM documents""")
def h16_stop(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", tx.tokenize("text").alias("tok"))
    kept = tx.drop_stop_words(docs, "tok", _STOP, out="kept")
    return kept.select("doc_id", F.size("tok").alias("n_tokens"), F.size("kept").alias("n_kept"))


@query("h17_alphabetic_and_name_list", f"""
WITH t AS (SELECT doc_id, {tok_sql('text')} AS tok FROM documents),
names AS (SELECT list(DISTINCT lower(split_part(c_name, '#', 1))) AS nl FROM customer)
SELECT doc_id, CAST(len(list_filter(tok, lambda x: regexp_full_match(x, '\\p{{L}}+'))) AS INTEGER) AS n_alpha,
       CAST(len(list_filter(tok, lambda x: NOT list_contains(nl, x))) AS INTEGER) AS n_not_name FROM t, names""")
def h17_alpha(spark, d):
    t = Tables(spark, d)
    docs = t.documents.select("doc_id", tx.tokenize("text").alias("tok"))
    names = t.customer.select(F.lower(F.split_part("c_name", F.lit("#"), F.lit(1))).alias("word")).distinct()
    kept = tx.drop_listed_words(docs, "doc_id", "tok", names)
    return kept.select("doc_id", F.size(tx.alphabetic_only("tok")).alias("n_alpha"), F.size("tokens_kept").alias("n_not_name"))


@query("h18_lemma_table_normalisation", f"""
WITH t AS (SELECT conv_id, turn, {tok_sql('text')} AS tok FROM conversations),
v AS (SELECT DISTINCT unnest(tok) AS w FROM t),
lem AS (SELECT w AS word, left(w, length(w) - 1) AS lemma FROM v WHERE w LIKE '%s' AND length(w) > 3
        AND left(w, length(w) - 1) IN (SELECT w FROM v)),
e AS (SELECT conv_id, turn, unnest(tok) AS word, generate_subscripts(tok, 1) AS pos FROM t)
SELECT conv_id, turn, string_agg(coalesce(lemma, word), ' ' ORDER BY pos) AS lemmas
FROM e LEFT JOIN lem USING (word) GROUP BY 1, 2""")
def h18_lemma(spark, d):
    c = Tables(spark, d).conversations
    docs = c.select(F.concat_ws("_", "conv_id", "turn").alias("doc"), "conv_id", "turn", tx.tokenize("text").alias("tok"))
    vocab = docs.select(F.explode("tok").alias("w")).distinct()
    cand = vocab.filter(F.col("w").endswith("s") & (F.length("w") > 3)).select(
        F.col("w").alias("word"), F.expr("substring(w, 1, length(w) - 1)").alias("lemma"))
    lem = cand.join(vocab.withColumnRenamed("w", "lemma"), "lemma", "left_semi")
    out = tx.lemmatize(docs.filter(F.size("tok") > 0), "doc", "tok", lem)
    return out.select("conv_id", "turn", F.array_join("lemmas", " ").alias("lemmas"))


@query("h19_json_list_first_field", """
SELECT event_id, CAST(json_extract('[' || props || ']', '$[0].k') AS INTEGER) AS k FROM events""")
def h19_json(spark, d):
    e = Tables(spark, d).events
    arr = F.concat(F.lit("["), F.col("props"), F.lit("]"))
    parsed = F.from_json(arr, "array<struct<k:int>>", {"allowSingleQuotes": "true"})
    return e.select("event_id", F.try_element_at(parsed, F.lit(1)).getField("k").alias("k"))


@query("h20_parse_and_format_dates", """
SELECT o_orderkey, CAST(strptime(strftime(o_orderdate, '%m/%Y'), '%m/%Y') AS DATE) AS month_start,
       make_date(year(o_orderdate), month(o_orderdate), 1) AS built, CAST(strftime(o_orderdate, '%Y%m') AS INTEGER) AS yyyymm,
       CAST(strptime(strftime(o_orderdate, '%Y-%m-%d'), '%Y-%m-%d') AS DATE) AS parsed FROM orders""")
def h20_dates(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", dt.parse_date(F.date_format("o_orderdate", "MM/yyyy"), "MM/yyyy").alias("month_start"),
                    dt.ymd(F.year("o_orderdate"), F.month("o_orderdate"), F.lit(1)).alias("built"),
                    dt.year_month("o_orderdate").alias("yyyymm"),
                    dt.parse_date(F.date_format("o_orderdate", "yyyy-MM-dd")).alias("parsed"))


@query("h21_hour_month_weekday_letter", """
SELECT event_id, CAST(hour(ts) AS INTEGER) AS hour, CAST(month(ts) AS INTEGER) AS month, CAST(isodow(ts) - 1 AS INTEGER) AS weekday,
       substr('LMXJVSD', isodow(ts), 1) AS weekday_letter FROM events""")
def h21_parts(spark, d):
    return Tables(spark, d).events.select("event_id", *dt.time_parts("ts"))


@query("h22_age_in_years", """
SELECT o_orderkey, round(datediff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') / 365.2425, 1) AS years FROM orders""")
def h22_age(spark, d):
    o = Tables(spark, d).orders
    return o.select("o_orderkey", dt.years_between(F.lit("2002-01-01").cast("date"), "o_orderdate").alias("years"))


@query("h23_month_name_number", """
SELECT m, name, CAST(m AS INTEGER) AS back FROM (
  SELECT DISTINCT CAST(month(o_orderdate) AS INTEGER) AS m, strftime(o_orderdate, '%B') AS name FROM orders)""")
def h23_months(spark, d):
    o = Tables(spark, d).orders.select(F.month("o_orderdate").alias("m")).distinct()
    named = o.withColumn("name", dt.month_name("m"))
    return named.withColumn("back", dt.month_number("name"))


@query("h24_haversine_distance", """
SELECT c_custkey, round(2 * 6371.0 * asin(sqrt(pow(sin((radians(40.4) - radians(c_acctbal / 200.0)) / 2), 2)
       + cos(radians(c_acctbal / 200.0)) * cos(radians(40.4))
       * pow(sin((radians(-3.7) - radians(c_nationkey * 5.0 - 60.0)) / 2), 2))), 6) AS km FROM customer""")
def h24_haversine(spark, d):
    c = Tables(spark, d).customer
    km = nu.haversine(F.col("c_acctbal") / 200.0, F.lit(40.4), F.col("c_nationkey") * 5.0 - 60.0, F.lit(-3.7))
    return c.select("c_custkey", F.round(km, 6).alias("km"))


@query("h25_log_abs_round_sqrt", """
SELECT c_custkey, round(ln(abs(c_acctbal) + 1), 9) AS log_abs, round(c_acctbal, 0) AS rounded,
       round(sqrt(abs(c_acctbal)), 9) AS root FROM customer""")
def h25_math(spark, d):
    c = Tables(spark, d).customer
    return c.select("c_custkey", F.round(F.log(F.abs("c_acctbal") + 1), 9).alias("log_abs"),
                    F.round("c_acctbal", 0).alias("rounded"), F.round(F.sqrt(F.abs("c_acctbal")), 9).alias("root"))


@query("h26_vector_algebra", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
r AS (SELECT x AS r FROM e ORDER BY vec_id LIMIT 1)
SELECT vec_id, round(list_dot_product(x, r), 6) AS dot, round(sqrt(list_dot_product(x, x)), 6) AS norm,
       round(list_cosine_similarity(x, r), 6) AS cosine, round((x[1] + r[1]) - (x[2] - r[2]), 6) AS add_sub FROM e, r""")
def h26_vectors(spark, d):
    e = Tables(spark, d).embeddings.select("vec_id", F.col("embedding").cast("array<double>").alias("x"))
    ref = F.array(*[F.lit(float(v)) for v in e.orderBy("vec_id").first()["x"]])       # one d-vector
    dot = F.aggregate(F.zip_with("x", ref, lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    norm = F.sqrt(F.aggregate(F.transform("x", lambda a: a * a), F.lit(0.0), lambda s, v: s + v))
    add = F.zip_with("x", ref, lambda a, b: a + b)
    sub = F.zip_with("x", ref, lambda a, b: a - b)
    return e.select("vec_id", F.round(dot, 6).alias("dot"), F.round(norm, 6).alias("norm"),
                    F.round(tm.cosine("x", ref), 6).alias("cosine"), F.round(add[0] - sub[1], 6).alias("add_sub"))


@query("h27_clip_negative", "SELECT c_custkey, greatest(c_acctbal, 0.0) AS clipped FROM customer")
def h27_clip(spark, d):
    return Tables(spark, d).customer.select("c_custkey", nu.clip_low("c_acctbal").alias("clipped"))


# ---------------------------------------------------------------- O ------------
_TOPIC_WORDS = 20_000      # vocabulary of a topic model, whose terms x topics the driver holds
_HASHED = 1 << 18          # places of hashed terms, whose dictionary nobody holds


def _docs_tok(spark, d):
    return Tables(spark, d).documents.select("doc_id", tx.tokenize("text").alias("tokens"))


@query("o1_bag_of_words_vocabulary", f"""
WITH t AS (SELECT doc_id, list_filter({tok_sql('text')}, lambda x: NOT list_contains({_sql_list(_STOP)}, x)) AS tok FROM documents),
tc AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest(tok) AS term FROM t) GROUP BY 1, 2),
v AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tc GROUP BY 1 ORDER BY cf DESC, term LIMIT 300)
SELECT term, df, CAST(cf AS BIGINT) AS cf FROM v""")
def o1_bow(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", tx.tokenize("text").alias("tokens"))
    toks = tx.drop_stop_words(docs, "tokens", _STOP)
    return tm.vocabulary(tm.term_counts(toks, "doc_id", "tokens"), "doc_id", 300)


@query("o2_tfidf_ngrams", f"""
WITH t AS (SELECT doc_id, {tok_sql('text')} AS tok FROM documents),
u AS (SELECT doc_id, unnest(tok) AS term FROM t
      UNION ALL SELECT doc_id, unnest(list_transform(range(1, len(tok)), lambda i: tok[i] || ' ' || tok[i + 1])) FROM t
      WHERE len(tok) >= 2),
tc AS (SELECT doc_id, term, count(*) AS tf FROM u GROUP BY 1, 2),
v AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM tc GROUP BY 1 HAVING count(*) >= 2 ORDER BY cf DESC, term LIMIT 500),
n AS (SELECT count(DISTINCT doc_id) AS n FROM documents),
w AS (SELECT doc_id, term, tf * (ln((1 + n) / (1 + df)) + 1) AS w FROM tc JOIN v USING (term), n)
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 9) AS weight FROM w""")
def o2_tfidf(spark, d):
    docs = spread(Tables(spark, d).documents.select("doc_id", "text")).select("doc_id", tx.tokenize("text").alias("tokens"))
    w = tm.tfidf(docs, "doc_id", "tokens", 1, 2, min_df=2, max_features=500)
    return w.withColumn("weight", F.round("weight", 9))


def _conv_tok(spark, d):
    c = Tables(spark, d).conversations
    return c.select(F.concat_ws("_", "conv_id", "turn").alias("doc"), tx.tokenize("text").alias("tokens"))


_CONV_TOK_SQL = f"""WITH t AS (SELECT conv_id || '_' || turn AS doc, {tok_sql('text')} AS tok FROM conversations),
e AS (SELECT doc, unnest(tok) AS term, generate_subscripts(tok, 1) AS pos FROM t)
"""


@query("o3_hapax_removal", _CONV_TOK_SQL + """,
c AS (SELECT term FROM e GROUP BY term HAVING count(*) = 1),
k AS (SELECT doc, string_agg(term, ' ' ORDER BY pos) AS s FROM e WHERE term NOT IN (SELECT term FROM c) GROUP BY doc)
SELECT t.doc, coalesce(s, '') AS tokens FROM t LEFT JOIN k USING (doc)""")
def o3_hapax(spark, d):
    out = tm.drop_hapax(_conv_tok(spark, d), "doc", "tokens")
    return out.select("doc", F.array_join("tokens", " ").alias("tokens"))


@query("o4_spam_style_job")
def o4_spam(spark, d):
    """Hand-made text features, TF-IDF of the 1000 terms that tell the classes apart best, logistic
    model, on documents x labels."""
    t = Tables(spark, d)
    x = t.documents.join(t.labels, "doc_id").select(
        "doc_id", F.col("toxic").cast("double").alias("label"), "text",
        F.length("text").cast("double").alias("n_chars"), sx.count_urls("text").cast("double").alias("n_urls"),
        sx.count_emails("text").cast("double").alias("n_emails"),
        F.round(sx.class_ratio("text", r"\p{Lu}", over=r"\p{L}"), 6).alias("upper_ratio"))
    x = spread(x)
    words = StopWordsRemover(inputCol="tok", outputCol="tok2", stopWords=_STOP).transform(
        RegexTokenizer(inputCol="text", outputCol="tok", pattern=r"[^\p{L}\p{N}]+", toLowercase=True).transform(x))
    best = [r.term for r in tm.k_best_terms(words, "tok2", "label", 1000, min_df=2).collect()]
    pipe = Pipeline(stages=[
        RegexTokenizer(inputCol="text", outputCol="tok", pattern=r"[^\p{L}\p{N}]+", toLowercase=True),
        StopWordsRemover(inputCol="tok", outputCol="tok2", stopWords=_STOP),
        CountVectorizerModel.from_vocabulary(best, inputCol="tok2", outputCol="tf"),
        IDF(inputCol="tf", outputCol="tfidf"),
        VectorAssembler(inputCols=["tfidf", "n_chars", "n_urls", "n_emails", "upper_ratio"], outputCol="features"),
        LogisticRegression(maxIter=30, regParam=0.01)])
    return pipe.fit(x).transform(x).select("doc_id", "label", "prediction")


@query("o4_k_best_terms", f"""
WITH t AS (SELECT doc_id, toxic AS y, {tok_sql('text')} AS tok FROM documents JOIN labels USING (doc_id) WHERE toxic IS NOT NULL),
p AS (SELECT doc_id, y, term, count(*) AS n FROM (SELECT doc_id, y, unnest(tok) AS term FROM t) GROUP BY ALL),
c AS (SELECT y, count(*)::DOUBLE AS nc FROM t GROUP BY y),
a AS (SELECT term, y, count(*) AS df, sum(n)::DOUBLE AS s, sum(n * n)::DOUBLE AS ss FROM p GROUP BY ALL),
g AS (SELECT term, sum(df)::BIGINT AS df, sum(s) AS s, sum(ss) AS ss, sum(s * s / nc) AS b FROM a JOIN c USING (y) GROUP BY term HAVING sum(df) >= 5),
k AS (SELECT sum(nc) AS n, count(*) AS c FROM c)
SELECT term, df, round(((b - s * s / n) / (c - 1)) / ((ss - b) / (n - c)), 6) AS f FROM g, k
ORDER BY ((b - s * s / n) / (c - 1)) / ((ss - b) / (n - c)) DESC, term LIMIT 40""")
def o4_terms(spark, d):
    """The 40 terms whose counts differ most between clean and toxic documents."""
    t = Tables(spark, d)
    x = t.documents.join(t.labels, "doc_id").select("toxic", tx.tokenize("text").alias("tokens"))
    return tm.k_best_terms(spread(x), "tokens", "toxic", 40, min_df=5).select("term", "df", F.round("f", 6).alias("f"))


@query("o5_word_index_padded_sequences", _CONV_TOK_SQL + """,
v AS (SELECT term, row_number() OVER (ORDER BY count(*) DESC, term) + 1 AS id FROM e GROUP BY term),
s AS (SELECT doc, list(id ORDER BY pos) AS ids FROM e JOIN v USING (term) GROUP BY doc),
a AS (SELECT t.doc, coalesce(ids, []) AS ids FROM t LEFT JOIN s USING (doc)),
m AS (SELECT max(len(ids)) AS L FROM a)
SELECT doc, array_to_string(list_concat(ids, list_resize([0], L - len(ids), 0)), ',') AS seq FROM a, m""")
def o5_sequences(spark, d):
    docs = _conv_tok(spark, d)
    idx = tm.word_index(docs, "tokens")
    seq = tm.to_sequences(docs, "doc", "tokens", idx)
    return seq.select("doc", F.array_join(F.transform("seq", lambda v: v.cast("string")), ",").alias("seq"))


@query("o6_dictionary_doc2bow", _CONV_TOK_SQL + """,
dic AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS token_id FROM (SELECT DISTINCT term FROM e))
SELECT doc, token_id, count(*) AS n, term FROM e JOIN dic USING (term) GROUP BY doc, token_id, term""")
def o6_doc2bow(spark, d):
    docs = _conv_tok(spark, d)
    dic = tm.dictionary(docs, "tokens")
    bow = tm.doc2bow(docs, "doc", "tokens", dic)
    long = bow.select("doc", F.explode("bow").alias("token_id", "n"))
    return long.join(dic, "token_id").select("doc", "token_id", "n", "term")


@query("o7_lda_document_mixture")
def o7_mixture(spark, d):
    """Share of each topic in each document."""
    docs = tx.drop_stop_words(_docs_tok(spark, d), "tokens", _STOP)
    _, _, mixture = tm.lda_topics(docs, "tokens", k=4, vocab=_TOPIC_WORDS, max_iter=10, top_n=8)
    return mixture.select("doc_id", F.posexplode(vector_to_array("topicDistribution")).alias("topic", "share"))


@query("o7_lda_topics")
def o7_lda(spark, d):
    docs = tx.drop_stop_words(_docs_tok(spark, d), "tokens", _STOP)
    _, topics, _ = tm.lda_topics(docs, "tokens", k=4, vocab=_TOPIC_WORDS, max_iter=10, top_n=8)
    return topics


_TOPIC_SQL = f"""WITH t AS (SELECT doc_id, lang, list_filter({tok_sql('text')}, lambda x: NOT list_contains({_sql_list(_STOP)}, x)) AS tok
           FROM documents),
c AS (SELECT lang, term, count(*) AS n FROM (SELECT lang, unnest(tok) AS term FROM t) GROUP BY 1, 2),
top AS (SELECT lang AS topic, term, row_number() OVER (PARTITION BY lang ORDER BY n DESC, term) - 1 AS rank FROM c
        QUALIFY rank < 8)
"""


@query("o8_topic_coherence", _TOPIC_SQL + """,
pres AS (SELECT DISTINCT doc_id, term FROM (SELECT doc_id, unnest(tok) AS term FROM t) WHERE term IN (SELECT term FROM top)),
nd AS (SELECT count(*) AS n FROM documents),
dfw AS (SELECT term, count(*) AS d FROM pres GROUP BY 1),
pairs AS (SELECT a.topic, a.term AS wi, b.term AS wj FROM top a JOIN top b ON a.topic = b.topic AND b.rank < a.rank),
co AS (SELECT x.term AS wi, y.term AS wj, count(*) AS dij FROM pres x JOIN pres y USING (doc_id) GROUP BY 1, 2),
j AS (SELECT p.topic, coalesce(dij, 0) AS dij, di.d AS di, dj.d AS dj FROM pairs p LEFT JOIN co USING (wi, wj)
      JOIN dfw di ON di.term = p.wi JOIN dfw dj ON dj.term = p.wj)
SELECT topic, round(sum(ln((dij + 1.0) / dj)), 6) AS umass,
       round(avg(ln((dij / n + 1e-12) / ((di / n) * (dj / n))) / (-ln(dij / n + 1e-12))), 6) AS npmi FROM j, nd GROUP BY topic""")
def o8_coherence(spark, d):
    docs = tx.drop_stop_words(spread(Tables(spark, d).documents).select("doc_id", "lang", tx.tokenize("text").alias("tokens")),
                              "tokens", _STOP)
    from tadkit.operators.windows import top_k
    cnt = docs.select("lang", F.explode("tokens").alias("term")).groupBy("lang", "term").agg(F.count(F.lit(1)).alias("n"))
    top = top_k(cnt, "lang", [F.col("n").desc(), F.col("term")], 8, rank_col="r").select(
        F.col("lang").alias("topic"), "term", (F.col("r") - 1).alias("rank"))
    coh = tm.topic_coherence(docs, "doc_id", "tokens", top)
    return coh.select("topic", F.round("umass", 6).alias("umass"), F.round("npmi", 6).alias("npmi"))


def _baskets(spark, d):
    from tadkit.operators.aggregate import ordered_basket
    t = Tables(spark, d)
    x = t.lineitem.join(t.orders.withColumnRenamed("o_orderkey", "l_orderkey"), "l_orderkey")
    return ordered_basket(x, "o_custkey", "o_orderdate", "l_partkey")


@query("o9_item_embeddings_word2vec")
def o9_w2v(spark, d):
    return tm.item_vectors(_baskets(spark, d), size=16, seed=7)


_SIM_SQL = """WITH e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
q AS (SELECT label AS query, arg_min(x, vec_id) AS qx, min(vec_id) AS qid FROM e GROUP BY label)
"""


@query("o10_similar_items_top_n", _SIM_SQL + """
SELECT vec_id, CAST(query AS VARCHAR) AS query, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank FROM (
  SELECT e.vec_id, q.query, list_cosine_similarity(e.x, q.qx) AS similarity,
         row_number() OVER (PARTITION BY q.query ORDER BY list_cosine_similarity(e.x, q.qx) DESC, e.vec_id) AS rank
  FROM e, q WHERE e.vec_id <> q.qid) WHERE rank <= 5""")
def o10_similar(spark, d):
    e = Tables(spark, d).embeddings
    firsts = e.groupBy("label").agg(F.min_by("embedding", "vec_id").alias("v"), F.min("vec_id").alias("id")).collect()
    queries = {r["label"]: r["v"] for r in firsts}                 # one vector per label, bounded
    excl = {r["label"]: [r["id"]] for r in firsts}
    out = tm.most_similar(e, "vec_id", "embedding", queries, 5, exclude=excl)
    return out.select("vec_id", "query", F.round("similarity", 6).alias("similarity"), "rank")


@query("o10_similar_items_described", _SIM_SQL + """,
t AS (SELECT e.vec_id, q.query, list_cosine_similarity(e.x, q.qx) AS similarity,
             row_number() OVER (PARTITION BY q.query ORDER BY list_cosine_similarity(e.x, q.qx) DESC, e.vec_id) AS rank
      FROM e, q WHERE e.vec_id <> q.qid)
SELECT vec_id, CAST(query AS VARCHAR) AS query, round(similarity, 6) AS similarity, CAST(rank AS INTEGER) AS rank, p_brand
FROM t LEFT JOIN part ON p_partkey = vec_id WHERE rank <= 5""")
def o10_described(spark, d):
    """Similar items with what the catalog says of them."""
    return tm.describe_items(o10_similar(spark, d), "vec_id", Tables(spark, d).part, "p_partkey", "p_brand")


@query("o12_pair_similarities", """
WITH w AS (SELECT unnest([0, 1, 2, 3, -5]) AS id, generate_subscripts([0, 1, 2, 3, -5], 1) AS i),
v AS (SELECT w.*, CAST(embedding AS DOUBLE[]) AS x FROM w LEFT JOIN embeddings ON vec_id = id)
SELECT a.id::BIGINT AS a, b.id::BIGINT AS b, a.x IS NOT NULL AS known_a, b.x IS NOT NULL AS known_b,
       round(list_cosine_similarity(a.x, b.x), 6) AS similarity FROM v a JOIN v b ON a.i < b.i""")
def o12_pairs(spark, d):
    """Similarity of every two of a list of words, one of which is unknown."""
    t = tm.pair_similarities(Tables(spark, d).embeddings, "vec_id", "embedding", [0, 1, 2, 3, -5])
    return t.withColumn("similarity", F.round("similarity", 6))


@query("o11_basket_mean_vector_recommend")
def o11_recommend(spark, d):
    """The five items nearest (cosine) to the mean item vector of every basket."""
    b = written(_baskets(spark, d), "baskets")
    vec = tm.item_vectors(b, size=16, seed=7)
    means = tm.basket_mean_vector(b, "o_custkey", "items", vec)
    norm = lambda c: F.sqrt(F.aggregate(c, F.lit(0.0), lambda s, v: s + v * v))
    unit = lambda c: F.transform(c, lambda v: F.try_divide(v, norm(c)))
    q = means.select(F.col("o_custkey").cast("string").alias("id"), unit(F.col("mean_vec")).alias("v"))
    items = vec.select(F.col("item").alias("id"), unit(F.col("vec").cast("array<double>")).alias("v"))
    return knn_exact(q, items, "id", "v", 5).select(
        F.col("query_id").alias("o_custkey"), F.col("ref_id").alias("item"), (1 - F.col("dist") * F.col("dist") / 2).alias("similarity"), "rank")


@query("o12_analogy_nearest", """
WITH e AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
ids AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) AS r FROM e),
a AS (SELECT x FROM e JOIN ids USING (vec_id) WHERE r = 1), b AS (SELECT x FROM e JOIN ids USING (vec_id) WHERE r = 2),
c AS (SELECT x FROM e JOIN ids USING (vec_id) WHERE r = 3),
t AS (SELECT list_transform(range(1, len(a.x) + 1), lambda i: a.x[i] - b.x[i] + c.x[i]) AS tx FROM a, b, c)
SELECT vec_id, round(list_cosine_similarity(e.x, t.tx), 6) AS similarity FROM e, t
WHERE vec_id NOT IN (SELECT vec_id FROM ids WHERE r <= 3)
ORDER BY list_cosine_similarity(e.x, t.tx) DESC, vec_id LIMIT 1""")
def o12_analogy(spark, d):
    e = Tables(spark, d).embeddings
    ids = [r["vec_id"] for r in e.select("vec_id").orderBy("vec_id").limit(3).collect()]
    target = tm.analogy_vector(e, "vec_id", "embedding", *ids)
    out = tm.most_similar(e, "vec_id", "embedding", {"analogy": target}, 1, exclude={"analogy": ids})
    return out.select("vec_id", F.round("similarity", 6).alias("similarity"))


@query("o13_cluster_documents_top_by_popularity")
def o13_docs(spark, d):
    docs = Tables(spark, d).documents.select("doc_id", "n_chars", tx.tokenize("text").alias("tokens"))
    tf = HashingTF(inputCol="tokens", outputCol="tf", numFeatures=_HASHED).transform(docs).select("doc_id", "n_chars", "tf")
    tf = tf.persist(StorageLevel.DISK_ONLY)             # each pass reads counts, not texts; same partitions, so the same clusters
    tfidf = IDF(inputCol="tf", outputCol="features", minDocFreq=2).fit(tf).transform(tf)
    lab = written(kmeans(tfidf, "features", 4).transform(tfidf).select("doc_id", "n_chars", "cluster"), "clusters")
    tf.unpersist()
    return tm.top_documents_per_cluster(lab, "cluster", "n_chars", "doc_id", 5)


@query("o14_lag_regression_forecast")
def o14_forecast(spark, d):
    o = Tables(spark, d).orders
    m = o.groupBy(F.col("o_orderpriority").alias("s"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")) \
        .agg(F.count(F.lit(1)).alias("y"))
    return tm.lag_regression_forecast(m, "s", "month", "y", lags=3, horizon=4)


@query("o14_rolling_origin_errors", """
WITH m AS (SELECT o_orderpriority AS s, date_trunc('month', o_orderdate) AS t, count(*)::DOUBLE AS y FROM orders GROUP BY 1, 2),
l AS (SELECT *, lag(y) OVER w AS x, row_number() OVER w AS pos FROM m WINDOW w AS (PARTITION BY s ORDER BY t)),
f AS (SELECT s, pos, y, count(x) OVER w AS n, sum(x) OVER w AS sx, sum(CASE WHEN x IS NOT NULL THEN y END) OVER w AS sy,
             sum(x * x) OVER w AS sxx, sum(x * y) OVER w AS sxy
      FROM l WINDOW w AS (PARTITION BY s ORDER BY t ROWS UNBOUNDED PRECEDING)),
b AS (SELECT s, pos, y, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS b1, n FROM f WHERE n >= 12),
c AS (SELECT b.s, b.pos, b.y, b1, (f.sy - b1 * f.sx) / f.n AS b0 FROM b JOIN f USING (s, pos)),
r AS (SELECT s, pos, b0 + b1 * y AS h1, b0 + b1 * (b0 + b1 * y) AS h2, b0 + b1 * (b0 + b1 * (b0 + b1 * y)) AS h3 FROM c),
e AS (SELECT r.s, k AS step, l.y AS actual, l.y - [h1, h2, h3][k] AS error FROM r, range(1, 4) ks(k) JOIN l ON l.s = r.s AND l.pos = r.pos + k)
SELECT s, step::INTEGER AS step, count(*) AS n, round(avg(abs(error)), 6) AS mae, round(avg(error * error), 5) AS mse,
       round(sqrt(avg(error * error)), 6) AS rmse, round(1 - avg(error * error) / var_pop(actual), 6) AS r2
FROM e GROUP BY s, step""")
def o14_rolling(spark, d):
    """Errors of the lag regression by steps ahead, fitted anew at every month from the twelfth on."""
    o = Tables(spark, d).orders
    m = o.groupBy(F.col("o_orderpriority").alias("s"), F.trunc(F.col("o_orderdate").cast("date"), "month").alias("month")) \
        .agg(F.count(F.lit(1)).alias("y"))
    e = tm.errors_by_step(tm.rolling_origin(m, "s", "month", "y", lags=1, horizon=3, min_train=12), ["s"])
    return e.select("s", "step", "n", *[F.round(c, 5 if c == "mse" else 6).alias(c) for c in ("mae", "mse", "rmse", "r2")])


@query("o15_future_month_index", """
WITH l AS (SELECT o_orderpriority AS s, max(CAST(o_orderdate AS DATE)) AS last FROM orders GROUP BY 1)
SELECT s, CAST(k AS INTEGER) AS step, CAST(date_trunc('month', last) + to_months(CAST(k AS INTEGER)) AS DATE) AS month
FROM l, range(1, 4) r(k)""")
def o15_future(spark, d):
    o = Tables(spark, d).orders.groupBy(F.col("o_orderpriority").alias("s")).agg(F.max(F.to_date("o_orderdate")).alias("last"))
    return tm.future_months(o, "s", "last", 3)


@query("o16_score_texts_with_stored_pipeline")
def o16_scoring(spark, d):
    t = Tables(spark, d)
    train = t.documents.join(t.labels, "doc_id").select("doc_id", "text", F.col("quality").cast("double").alias("label"))
    pipe = Pipeline(stages=[RegexTokenizer(inputCol="text", outputCol="tok", pattern=r"[^\p{L}\p{N}]+"),
                            HashingTF(inputCol="tok", outputCol="tf", numFeatures=_HASHED), IDF(inputCol="tf", outputCol="features"),
                            LogisticRegression(maxIter=20)])
    path = scratch_path(spark, "text-pipeline")
    pipe.fit(train).write().overwrite().save(path)
    from pyspark.ml import PipelineModel
    return PipelineModel.load(path).transform(t.documents.select("doc_id", "text")).select("doc_id", "prediction")
