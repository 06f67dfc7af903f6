"""Text mining, embeddings, recommendation and series.

Documents are exploded to (doc, position, token) rows only where a corpus
statistic is needed (document frequencies, vocabularies); every statistic is
a grouped aggregate, and per-document results are re-assembled by a group-by
on the document id (bounded by the document's own length).  Vocabulary ids
come from the range-sorted dense id (no single-task window), and similarity
search multiplies each row by a bounded literal set of query vectors instead
of joining tables pairwise.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tadkit.operators.frame import add_row_id, spread
from tadkit.session import written


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def ngrams(tokens, n_min: int = 1, n_max: int = 1) -> Column:
    """All n-grams (n_min..n_max) of a token array, space-joined, in order.

    Built by zipping the array with its shifted slices, so the token array
    is referenced a constant number of times per row (a per-position lambda
    over the array would make Catalyst re-evaluate the tokenizer per element).
    """
    t = _c(tokens)
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(t)
            continue
        L = F.greatest(F.size(t) - n + 1, F.lit(0))
        shifted = [F.slice(t, k + 1, L) for k in range(n)]
        z = F.arrays_zip(*shifted)

        def joiner(n):
            return lambda s: F.concat_ws(" ", *[s[str(k)] for k in range(n)])
        parts.append(F.transform(z, joiner(n)))
    return parts[0] if len(parts) == 1 else F.concat(*parts)


def term_counts(df: DataFrame, doc: str, tokens: str) -> DataFrame:
    """(doc, term, tf) for every term of every document.

    A document is one row, so the partial aggregate reduces its words to
    counts before anything is shuffled.  ``explode_outer`` + a null filter
    keeps Catalyst from inferring a size() filter that would re-run the
    tokenizer."""
    ex = df.select(doc, F.explode_outer(tokens).alias("term")).filter(F.col("term").isNotNull())
    return ex.groupBy(doc, "term").agg(F.count(F.lit(1)).alias("tf"))


# O1 ------------------------------------------------------------------------
def vocabulary(tc: DataFrame, doc: str, max_features: int | None = None, min_df: int = 1) -> DataFrame:
    """(term, df, cf): terms kept by min_df, then the max_features most
    frequent by corpus count (ties -> term order), like ``CountVectorizer``."""
    v = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("cf")).filter(F.col("df") >= min_df)
    if max_features:
        v = v.orderBy(F.col("cf").desc(), "term").limit(max_features)   # top-k (partial per partition)
    return v


def count_vectorizer(in_col: str = "tokens", out_col: str = "bow", vocab: int = 1000, min_df: float = 1.0):
    return CountVectorizer(inputCol=in_col, outputCol=out_col, vocabSize=vocab, minDF=min_df)


# O2 ------------------------------------------------------------------------
def tfidf(df: DataFrame, doc: str, tokens: str, n_min: int = 1, n_max: int = 1, min_df: int = 1,
          max_features: int | None = None, smooth: bool = True, norm: bool = True) -> DataFrame:
    """scikit-learn TF-IDF as DataFrame ops: idf = ln((1 + n) / (1 + df)) + 1
    (smooth), weight = tf * idf, l2-normalised per document.  Long output
    (doc, term, weight) — the sparse matrix without a driver-side vocabulary.  A
    document is one row.

    With ``max_features`` the vocabulary comes first: terms are counted batch by batch, so
    that counts by term are all that is shuffled; then the vocabulary (max_features rows, held by
    every task) cuts each batch's counts by document.  Without it all terms are counted by document."""
    n = df.agg(F.count_distinct(doc)).scalar()
    if max_features:
        x = spread(df).select(doc, tokens)
        v = _vocabulary_of(x.select(tokens), n_min, n_max, max_features, min_df).collect()
        tc = _vocabulary_counts(x, n_min, n_max, {r.term: r.df for r in v}).repartition(doc) \
            .groupBy(doc, "term").agg(F.sum("tf").alias("tf"), F.first("df").alias("df"))
    else:
        tc = term_counts(spread(df).select(doc, ngrams(tokens, n_min, n_max).alias("_g")), doc, "_g")
        tc = tc.join(vocabulary(tc, doc, None, min_df).select("term", "df"), "term")
    idf = (F.log((1 + n) / (1 + F.col("df"))) + 1) if smooth else (F.log(n / F.col("df")) + 1)
    w = tc.withColumn("w", F.col("tf") * idf)
    if norm:
        w = w.withColumn("w", F.col("w") / F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(doc))))
    return w.select(doc, "term", F.col("w").alias("weight"))


def _gram_counts(t: pa.Array, n_min: int, n_max: int) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The ``ngrams`` of lists of tokens: distinct terms, and by row and term of it (their numbers) how often."""
    flat = t.flatten()
    row = np.repeat(np.arange(len(t)), pc.fill_null(pc.list_value_length(t), 0).to_numpy(zero_copy_only=False))
    d = flat.dictionary_encode(null_encoding="encode")
    ids = gram = d.indices.to_numpy().astype(np.int64)
    texts, rows, grams, known = [pa.array([], flat.type)], [], [], 0
    for n in range(1, n_max + 1):
        if n > 1:                                # the gram before it and one token more, in the same row
            keep = row[:max(len(row) - n + 1, 0)] == row[n - 1:]
            at = np.flatnonzero(keep)
            pair = gram[at] * len(d.dictionary) + ids[at + n - 1]
        else:
            at, pair = np.arange(len(ids)), ids
        _, first, place = np.unique(pair, return_index=True, return_inverse=True)
        gram = np.full(len(ids), -1)
        gram[at] = place
        if n >= n_min and len(first):
            of = [flat.take(pa.array(at[first] + k)) for k in range(n)]
            texts.append(pc.binary_join_element_wise(*of, " ", null_handling="skip") if n > 1 else of[0])
            rows.append(row[at])
            grams.append(place + known)
            known += len(first)
    one = pa.chunked_array(texts).combine_chunks().dictionary_encode()           # grams of unlike length may read alike; no null here
    if not known:
        return one.dictionary, *[np.zeros(0, np.int64)] * 3
    to = pc.fill_null(one.indices, -1).to_numpy().astype(np.int64)[np.concatenate(grams)]
    pair, tf = np.unique((np.concatenate(rows) * max(len(one.dictionary), 1) + to)[to >= 0], return_counts=True)
    return one.dictionary, pair // max(len(one.dictionary), 1), pair % max(len(one.dictionary), 1), tf


def _vocabulary_of(x: DataFrame, n_min: int, n_max: int, max_features: int, min_df: int, rows: int = 512) -> DataFrame:
    """``vocabulary`` of the n-grams of rows of tokens, without counts by document."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                terms, _, term, tf = _gram_counts(batch.column(0).slice(at, rows), n_min, n_max)
                df, cf = np.bincount(term, minlength=len(terms)), np.bincount(term, tf, len(terms)).astype(np.int64)
                yield pa.record_batch([terms, pa.array(df), pa.array(cf)], names=["term", "df", "cf"])
    v = x.mapInArrow(count, "term string, df long, cf long").groupBy("term").agg(F.sum("df").alias("df"), F.sum("cf").alias("cf"))
    return v.filter(F.col("df") >= min_df).orderBy(F.col("cf").desc(), "term").limit(max_features)


def _vocabulary_counts(x: DataFrame, n_min: int, n_max: int, vocabulary: dict[str, int], rows: int = 512) -> DataFrame:
    """(doc, term, tf, df) of the n-grams of (doc, tokens) that the vocabulary (term: df) has."""
    doc, kind = x.dtypes[0]
    words, dfs = pa.array(vocabulary.keys(), pa.string()), pa.array(vocabulary.values(), pa.int64())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                terms, row, term, tf = _gram_counts(part.column(1), n_min, n_max)
                place = pc.fill_null(pc.index_in(terms, words), -1).to_numpy()[term]
                kept = np.flatnonzero(place >= 0)
                place = pa.array(place[kept])
                yield pa.record_batch([part.column(0).take(pa.array(row[kept])), words.take(place), pa.array(tf[kept]), dfs.take(place)],
                                      names=[doc, "term", "tf", "df"])
    return x.mapInArrow(count, f"`{doc}` {kind}, term string, tf long, df long")


# O3 ------------------------------------------------------------------------
def drop_hapax(df: DataFrame, doc: str, tokens: str, out: str = "tokens") -> DataFrame:
    """Remove words seen exactly once in the whole corpus; order kept."""
    ex = df.select(doc, F.posexplode(tokens).alias("_pos", "term"))
    cnt = ex.groupBy("term").agg(F.count(F.lit(1)).alias("_n"))
    kept = ex.join(cnt.filter("_n = 1").select("term"), "term", "left_anti")
    reg = kept.groupBy(doc).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "term"))), lambda s: s["term"]).alias(out))
    return df.select(doc).join(reg, doc, "left").withColumn(out, F.coalesce(F.col(out), F.array().cast("array<string>")))


# O5 ------------------------------------------------------------------------
def word_index(df: DataFrame, tokens: str, num_words: int | None = None, oov_id: int = 1) -> DataFrame:
    """(term, id): ids by descending frequency (ties -> term), starting after
    the OOV id; ids are a range-sorted dense numbering."""
    cnt = df.select(F.explode(tokens).alias("term")).groupBy("term").agg(F.count(F.lit(1)).alias("_n"))
    ided = add_row_id(cnt, [F.col("_n").desc(), "term"], alias="_r")
    ided = ided.withColumn("id", F.col("_r") + oov_id)
    if num_words:
        ided = ided.filter(F.col("id") < num_words)
    return ided.select("term", "id")


def to_sequences(df: DataFrame, doc: str, tokens: str, index: DataFrame, oov_id: int = 1, pad_to: int | None = None,
                 out: str = "seq") -> DataFrame:
    """Token ids in order (OOV -> oov_id), post-padded with 0 to ``pad_to``
    (default: the longest sequence; nothing is truncated)."""
    ex = df.select(doc, F.posexplode(tokens).alias("_pos", "term"))
    ids = ex.join(index, "term", "left").withColumn("id", F.coalesce("id", F.lit(oov_id)))
    seq = ids.groupBy(doc).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "id"))), lambda s: s["id"]).alias(out))
    seq = df.select(doc).join(seq, doc, "left").withColumn(out, F.coalesce(F.col(out), F.array().cast("array<bigint>")))
    L = pad_to if pad_to is not None else seq.agg(F.max(F.size(out))).scalar()
    pad = F.array_repeat(F.lit(0).cast("bigint"), (L - F.size(out)).cast("int"))
    return seq.withColumn(out, F.concat(F.col(out), pad))


# O6 ------------------------------------------------------------------------
def dictionary(df: DataFrame, tokens: str) -> DataFrame:
    """(term, token_id): ids 0..V-1 in term order."""
    terms = df.select(F.explode(tokens).alias("term")).distinct()
    return add_row_id(terms, ["term"], alias="_r").select("term", (F.col("_r") - 1).alias("token_id"))


def doc2bow(df: DataFrame, doc: str, tokens: str, dic: DataFrame) -> DataFrame:
    """Per document a map token_id -> count (and the long form behind it)."""
    tc = term_counts(df, doc, tokens).join(dic, "term")
    return tc.groupBy(doc).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("token_id", "tf")))).alias("bow"))


# O7 / O8 -----------------------------------------------------------------------
def lda_topics(df: DataFrame, tokens: str, k: int = 5, vocab: int = 2000, max_iter: int = 20, seed: int = 42,
               top_n: int = 10):
    """pyspark.ml LDA; returns (model, topics table (topic, rank, term, weight), doc mixtures)."""
    from pyspark.ml.clustering import LDA
    cvm = CountVectorizer(inputCol=tokens, outputCol="_bow", vocabSize=vocab).fit(df)
    bow = cvm.transform(df)
    model = LDA(k=k, maxIter=max_iter, seed=seed, featuresCol="_bow").fit(bow)
    voc = cvm.vocabulary
    rows = []
    for r in model.describeTopics(top_n).collect():          # k x top_n, bounded
        for rank, (ti, w) in enumerate(zip(r["termIndices"], r["termWeights"])):
            rows.append((int(r["topic"]), rank, voc[ti], float(w)))
    topics = df.sparkSession.createDataFrame(rows, "topic int, rank int, term string, weight double")
    return model, topics, model.transform(bow).drop("_bow")


def topic_coherence(df: DataFrame, doc: str, tokens: str, topics: DataFrame, eps: float = 1.0) -> DataFrame:
    """UMass and NPMI coherence of each topic's top words from document
    co-occurrence counts (only the topics' words are paired per document).

    The topics and the documents' words among theirs are each made once and kept; other
    words are dropped where they are read."""
    topics = written(topics, "topics")
    words = topics.select("term").distinct()                               # topics x top_n rows
    pres = df.select(doc, F.explode(F.array_distinct(tokens)).alias("term")).join(F.broadcast(words), "term").distinct()
    pres = written(pres, "presence")
    n_docs = df.agg(F.count_distinct(doc)).scalar()
    dfw = pres.groupBy("term").agg(F.count(F.lit(1)).alias("d"))
    a = topics.select("topic", F.col("term").alias("wi"), F.col("rank").alias("ri"))
    b = topics.select("topic", F.col("term").alias("wj"), F.col("rank").alias("rj"))
    pairs = a.join(b, "topic").filter(F.col("rj") < F.col("ri"))          # top_n^2 / 2 per topic
    x = pres.select(doc, F.col("term").alias("wi"))
    y = pres.select(doc, F.col("term").alias("wj"))
    co = x.join(y, doc).join(pairs.select("wi", "wj").distinct(), ["wi", "wj"]) \
        .groupBy("wi", "wj").agg(F.count(F.lit(1)).alias("dij"))
    j = pairs.join(co, ["wi", "wj"], "left").na.fill(0, ["dij"]) \
        .join(dfw.select(F.col("term").alias("wi"), F.col("d").alias("di")), "wi") \
        .join(dfw.select(F.col("term").alias("wj"), F.col("d").alias("dj")), "wj")
    umass = F.log((F.col("dij") + eps) / F.col("dj"))
    pij = F.col("dij") / n_docs
    pmi = F.log((pij + 1e-12) / ((F.col("di") / n_docs) * (F.col("dj") / n_docs)))
    npmi = pmi / (-F.log(pij + 1e-12))
    return j.groupBy("topic").agg(F.sum(umass).alias("umass"), F.avg(npmi).alias("npmi"))


# O9 - O12 ---------------------------------------------------------------------
_BLOCK = 1 << 21             # items of baskets that are trained together, at most


def _first_vectors(words: pa.Array, size: int, seed: int, rows: int = 1 << 16) -> np.ndarray:
    """Where each word's vector starts: uniform in +-0.5 / size, drawn from the word and the seed alone, so that all blocks agree."""
    out = np.empty((len(words), size), np.float32)
    draw = (np.arange(1, size + 1, dtype=np.uint64) + np.uint64(seed % 2 ** 32 * size)) * np.uint64(0x9E3779B97F4A7C15)
    for at in range(0, len(words), rows):
        z = pd.util.hash_array(np.array(words.slice(at, rows).to_pylist(), dtype=object), categorize=False)[:, None] + draw
        for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
            z = (z ^ (z >> np.uint64(shift))) * np.uint64(factor)
        out[at:at + rows] = ((z >> np.uint64(40)) / 2.0 ** 24 - 0.5) / size
    return out


def _move(v: np.ndarray, at: np.ndarray, by: np.ndarray, weight: np.ndarray, rate: float) -> None:
    """Add ``rate`` times the sum of each row's steps; where a row has so many that these would be more than their mean, their mean."""
    order = np.argsort(at, kind="stable")
    s = at[order]
    first = np.flatnonzero(np.concatenate([[True], s[1:] != s[:-1]]))
    n = np.add.reduceat(weight[order], first)
    v[s[first]] += np.add.reduceat(by[order], first, axis=0) * (rate / np.maximum(1, rate * n))[:, None].astype(v.dtype)


def _skip_gram(ids: np.ndarray, basket: np.ndarray, v: np.ndarray, window: int, passes: int, rng: np.random.Generator,
               alpha: float = 0.025, negative: int = 5, drawn: int = 32) -> None:
    """Skip-gram with negative sampling over one block, in place: each item against those up to ``window`` places away in
    its basket (nearer ones more often), and against ``drawn`` items a step, drawn by count ** 0.75, which weigh
    ``negative`` together.  The rate falls to 0 in a line."""
    n, out = len(ids), np.zeros_like(v)
    step = min(1024, max(32, n // 128))
    noise = np.cumsum(np.bincount(ids, minlength=len(v)) ** 0.75)
    offset = np.array([o for o in range(-window, window + 1) if o])
    for at in range(0, n * passes, step):
        rate = alpha * max(1 - at / (n * passes), 1e-4)
        i = np.arange(at, min(at + step, n * passes)) % n
        j = i[:, None] + offset
        near = (np.abs(offset) <= rng.integers(1, window + 1, len(i))[:, None]) & (j >= 0) & (j < n)
        row, col = np.nonzero(near & (basket[np.clip(j, 0, n - 1)] == basket[i][:, None]))
        if not len(row):
            continue
        a, b = ids[j[row, col]], ids[i[row]]
        other = np.searchsorted(noise, rng.random(drawn) * noise[-1], side="right").clip(max=len(v) - 1)
        x, y, z = v[a], out[b], out[other]
        pull = (1 / (1 + np.exp((x * y).sum(axis=1))))[:, None]
        push = np.where(b[:, None] == other, np.float32(0), -negative / drawn / (1 + np.exp(-(x @ z.T)))).astype(v.dtype)
        one = np.ones(len(a))
        _move(v, a, pull * y + push @ z, one, rate)
        _move(out, np.concatenate([b, other]), np.concatenate([pull * x, push.T @ x]),
              np.concatenate([one, np.full(drawn, len(a) * negative / drawn)]), rate)


def item_vectors(baskets: DataFrame, items: str = "items", size: int = 32, window: int = 5, min_count: int = 1,
                 seed: int = 42, max_iter: int = 1, partitions: int | None = None) -> DataFrame:
    """Word2Vec (skip-gram, negative sampling) over ordered baskets -> (item, vector array), trained in
    ``partitions`` tasks (the shuffle partitions unless given).

    A task trains blocks of some ``_BLOCK`` items, ``max_iter`` times over each, all from the same start; an item's
    vector is the mean over the blocks it is in, by its count there.  A task holds the vectors of one block's
    items, the driver none.  Items seen less than ``min_count`` times are left out first."""
    partitions, block = partitions or int(baskets.sparkSession.conf.get("spark.sql.shuffle.partitions")), _BLOCK
    rows = baskets.select(F.transform(items, lambda x: x.cast("string")).alias("_b"))
    if min_count > 1:
        e = written(rows.select(F.monotonically_increasing_id().alias("_id"), F.posexplode("_b").alias("_at", "item")), "basket-items")
        known = e.groupBy("item").agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") >= min_count).select("item")
        rows = e.join(known, "item").groupBy("_id").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("_at", "item"))), lambda s: s["item"]).alias("_b")).select("_b")

    def blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.ChunkedArray]:
        held, n = [], 0
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                held.append(batch.column(0).slice(at, 64))
                n += pc.sum(pc.list_value_length(held[-1])).as_py() or 0
                if n >= block:
                    yield pa.chunked_array(held)
                    held, n = [], 0
        if n:
            yield pa.chunked_array(held)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        for k, b in enumerate(blocks(batches)):
            d = pc.dictionary_encode(pc.list_flatten(b).combine_chunks(), null_encoding="encode")
            ids = d.indices.to_numpy()
            v = _first_vectors(d.dictionary, size, seed)
            rng = np.random.default_rng([seed % 2 ** 32, TaskContext.get().partitionId(), k])
            _skip_gram(ids, np.repeat(np.arange(len(b), dtype=np.int32), pc.fill_null(pc.list_value_length(b), 0).to_numpy()), v, window, max_iter, rng)
            n = np.bincount(ids, minlength=len(v))
            for at in range(0, len(v), 10_000):
                part = v[at:at + 10_000]
                ends = pa.array(np.arange(len(part) + 1, dtype=np.int32) * size)
                yield pa.record_batch([d.dictionary.slice(at, 10_000), pa.ListArray.from_arrays(ends, pa.array(part.ravel())), pa.array(n[at:at + 10_000])],
                                      names=["item", "vec", "n"])
    parts = rows.repartition(partitions).sortWithinPartitions(F.xxhash64("_b")).mapInArrow(train, "item string, vec array<float>, n long")
    sums = parts.groupBy("item").agg(F.sum("n").alias("_n"), *[F.sum(F.col("vec")[i].cast("double") * F.col("n")).alias(f"_{i}") for i in range(size)])
    return written(sums.select("item", F.array(*[F.col(f"_{i}") / F.col("_n") for i in range(size)]).alias("vec")), "item-vectors")


def cosine(a, b) -> Column:
    """Cosine of two arrays; null if either is zero."""
    a, b = _c(a), _c(b)
    dot = F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, v: s + v)
    na = F.sqrt(F.aggregate(F.transform(a, lambda x: x * x), F.lit(0.0), lambda s, v: s + v))
    nb = F.sqrt(F.aggregate(F.transform(b, lambda x: x * x), F.lit(0.0), lambda s, v: s + v))
    return F.try_divide(dot, na * nb)


def most_similar(vectors: DataFrame, key: str, vec: str, queries: dict, top_n: int = 5,
                 exclude: dict | None = None) -> DataFrame:
    """Top-n cosine neighbours of a few query vectors (a bounded literal set),
    excluding the query's own inputs.  Each row is scored against every query
    in one projection; the top-n per query is a grouped top-k."""
    q_ids = list(queries)
    lits = {q: F.array(*[F.lit(float(v)) for v in queries[q]]) for q in q_ids}
    scored = vectors.select(key, F.explode(F.array(*[
        F.struct(F.lit(str(q)).alias("query"), cosine(F.col(vec).cast("array<double>"), lits[q]).alias("similarity"))
        for q in q_ids])).alias("_s")).select(key, "_s.query", "_s.similarity")
    if exclude:
        for q, ids in exclude.items():
            scored = scored.filter(~((F.col("query") == str(q)) & F.col(key).isin(list(ids))))
    from tadkit.operators.windows import top_k
    return top_k(scored, "query", [F.col("similarity").desc(), F.col(key)], top_n)


def describe_items(similar: DataFrame, key: str, catalog: DataFrame, catalog_key: str, description: str) -> DataFrame:
    """The rows with the ``description`` of their item, null where the catalog lacks it
    (of rows that repeat a key the least description)."""
    names = catalog.filter(F.col(catalog_key).isNotNull()).groupBy(F.col(catalog_key).alias("_key")).agg(F.min(description).alias(description))
    return similar.join(names, F.col(key) == F.col("_key"), "left").drop("_key")


def pair_similarities(vectors: DataFrame, key: str, vec: str, words: Sequence) -> DataFrame:
    """Cosine of every two of the given ``words`` (a, b, similarity), in their order, with
    known_a and known_b; a pair with an unknown word has no similarity.

    The answer has a row for each pair of the list, so the list is what bounds it."""
    spark = vectors.sparkSession
    kind = dict(vectors.dtypes)[key]
    found = vectors.filter(F.col(key).isin(list(words))).groupBy(F.col(key).alias("_w")).agg(F.min(F.col(vec).cast("array<double>")).alias("_v"))
    given = list(dict.fromkeys(words))
    pairs = spark.createDataFrame([(a, b) for i, a in enumerate(given) for b in given[i + 1:]], f"a {kind}, b {kind}")
    for side in "ab":
        pairs = pairs.join(found.select(F.col("_w").alias(side), F.col("_v").alias(f"_{side}")), side, "left")
    return pairs.select("a", "b", F.col("_a").isNotNull().alias("known_a"), F.col("_b").isNotNull().alias("known_b"), cosine("_a", "_b").alias("similarity"))


def _term_sums(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Of rows (class, terms), by term and class: rows that have the term, the sum of their counts and of the counts' squares."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            y, t = batch.slice(at, rows).columns
            flat = t.flatten()
            doc = np.repeat(np.arange(len(t)), pc.fill_null(pc.list_value_length(t), 0).to_numpy(zero_copy_only=False))
            known = pc.is_valid(flat).to_numpy(zero_copy_only=False)
            terms, classes = flat.drop_null().dictionary_encode(), y.dictionary_encode()
            if not len(terms):
                continue
            v, of = len(terms.dictionary), classes.indices.to_numpy()
            pair, n = np.unique(doc[known].astype(np.int64) * v + terms.indices.to_numpy(), return_counts=True)
            cell, place = np.unique(of[pair // v].astype(np.int64) * v + pair % v, return_inverse=True)
            sums = [np.bincount(place, w, len(cell)).astype(np.int64) for w in (None, n, n * n)]
            yield pa.record_batch([terms.dictionary.take(pa.array(cell % v)), classes.dictionary.take(pa.array(cell // v)), *map(pa.array, sums)],
                                  names=["term", "_y", "df", "s", "ss"])


def k_best_terms(df: DataFrame, tokens: str, label: str, k: int, min_df: int = 1) -> DataFrame:
    """K10 for text: (term, df, f) of the ``k`` terms whose counts differ most between the classes
    of ``label`` by the ANOVA F statistic; ties go to the earlier term.

    A row is a document.  Sums by term and class come from one shuffle of each batch's sums; documents
    without a term count as 0 there without being made.  Rows without label are dropped.
    """
    x = df.filter(F.col(label).isNotNull()).select(F.col(label).alias("_y"), F.col(tokens).alias("_t"))
    kind = dict(x.dtypes)["_y"]
    cell = x.mapInArrow(_term_sums, f"term string, _y {kind}, df long, s long, ss long").groupBy("term", "_y") \
        .agg(*[F.sum(c).alias(c) for c in ("df", "s", "ss")])
    classes = x.groupBy("_y").agg(F.count(F.lit(1)).alias("nc"))
    n, c = classes.agg(F.sum("nc")).scalar(), classes.agg(F.count(F.lit(1))).scalar()
    t = cell.join(classes, "_y").groupBy("term").agg(F.sum("df").alias("df"), F.sum("s").cast("double").alias("s"), F.sum("ss").cast("double").alias("ss"),
                                                     F.sum(F.col("s") * F.col("s") / F.col("nc")).alias("b")).filter(F.col("df") >= min_df)
    between, inside = F.col("b") - F.col("s") * F.col("s") / n, F.col("ss") - F.col("b")
    f = F.try_divide(between / (c - 1), inside / (n - c))
    return t.select("term", "df", f.alias("f")).orderBy(F.col("f").desc_nulls_last(), "term").limit(k)


def basket_mean_vector(baskets: DataFrame, key: str, items: str, vectors: DataFrame) -> DataFrame:
    """Mean item vector per basket; unknown items are skipped."""
    ex = baskets.select(key, F.explode(items).alias("item")).withColumn("item", F.col("item").cast("string"))
    size = vectors.agg(F.max(F.size("vec"))).first()[0] or 0
    mean = F.array(*[F.avg(F.get("vec", F.lit(i))) for i in range(size)]).cast("array<double>")
    return ex.join(vectors, "item").groupBy(key).agg(F.slice(mean, F.lit(1), F.max(F.size("vec"))).alias("mean_vec"))


def analogy_vector(vectors: DataFrame, key: str, vec: str, a, b, c) -> list[float]:
    """a - b + c from three rows (three vectors to the driver, bounded)."""
    rows = {r[key]: np.array(r[vec], dtype=float) for r in vectors.filter(F.col(key).isin([a, b, c])).collect()}
    return list(rows[a] - rows[b] + rows[c])


# O13 -----------------------------------------------------------------------
def top_documents_per_cluster(df: DataFrame, cluster: str, popularity: str, key: str, n: int = 5) -> DataFrame:
    from tadkit.operators.windows import top_k
    return top_k(df, cluster, [F.col(popularity).desc(), F.col(key)], n)


# O14 -----------------------------------------------------------------------
def lag_regression_forecast(series: DataFrame, key: str, t: str, y: str, lags: int, horizon: int) -> DataFrame:
    """Per series, OLS of y_t on (1, y_{t-1..t-lags}) and a recursive forecast.

    The normal equations (X'X, X'y) are partial-aggregated sums per series,
    so a long series is never gathered; each series' (lags+1)^2 system and
    its last ``lags`` values feed a small pandas UDF that rolls forward."""
    from tadkit.operators.windows import lag_columns
    x = lag_columns(series.select(key, t, F.col(y).cast("double").alias("_y")), [key], [t], "_y",
                    list(range(1, lags + 1)), prefix="_l")
    fit = x.filter(F.col(f"_l{lags}").isNotNull())
    feats = [F.lit(1.0)] + [F.col(f"_l{i}") for i in range(1, lags + 1)]
    p = lags + 1
    aggs = [F.sum(feats[i] * feats[j]).alias(f"a{i}_{j}") for i in range(p) for j in range(p)]
    aggs += [F.sum(feats[i] * F.col("_y")).alias(f"b{i}") for i in range(p)]
    normal = fit.groupBy(key).agg(*aggs)
    last = x.groupBy(key).agg(F.max_by(F.array(*[F.col("_y")] + [F.col(f"_l{i}") for i in range(1, lags)]), t).alias("_last"),
                              F.max(t).alias("_t"))
    j = normal.join(last, key)

    @F.pandas_udf("array<double>")
    def roll(*cols: pd.Series) -> pd.Series:
        out = []
        A_cols, b_cols, lastc = cols[: p * p], cols[p * p: p * p + p], cols[-1]
        for r in range(len(lastc)):
            A = np.array([c.iloc[r] for c in A_cols], dtype=float).reshape(p, p)
            bb = np.array([c.iloc[r] for c in b_cols], dtype=float)
            beta = np.linalg.lstsq(A, bb, rcond=None)[0]
            hist = list(lastc.iloc[r])                      # y_t, y_{t-1}, ...
            preds = []
            for _ in range(horizon):
                yhat = beta[0] + sum(beta[i] * hist[i - 1] for i in range(1, p))
                preds.append(float(yhat))
                hist = [yhat] + hist[:-1]
            out.append(preds)
        return pd.Series(out)

    a_cols = [F.col(f"a{i}_{j}") for i in range(p) for j in range(p)]
    b_cols = [F.col(f"b{i}") for i in range(p)]
    return j.select(key, "_t", roll(*a_cols, *b_cols, F.col("_last")).alias("forecast"))


def rolling_origin(series: DataFrame, key: str, t: str, y: str, lags: int, horizon: int, min_train: int, window: int | None = None) -> DataFrame:
    """Forecasts from every origin: key, origin, step, target time, actual, forecast, error.

    At each time with at least ``min_train`` usable rows behind it, the lag
    regression of ``lag_regression_forecast`` is fitted to the rows up to there (the
    last ``window`` rows, if given) and rolled ``horizon`` steps.  The normal equations are
    running sums over time, so a fit is one row, or the difference of two; no
    fit reads the series again.  Rows of a null key or time are dropped; a row whose lags or
    value are null is no training row, and no origin.
    """
    from tadkit.operators.frame import cumulative_sum
    from tadkit.operators.windows import lag_columns
    p = lags + 1
    src = series.filter(F.col(key).isNotNull() & F.col(t).isNotNull()).select(key, t, F.col(y).cast("double").alias("_y"))
    x = lag_columns(src, [key], [t], "_y", list(range(1, lags + 1)), prefix="_l")
    feats = [F.lit(1.0)] + [F.col(f"_l{i}") for i in range(1, p)]
    usable = functools.reduce(lambda a, b: a & b, [c.isNotNull() for c in [*feats[1:], F.col("_y")]])
    sums = {f"a{i}_{j}": feats[i] * feats[j] for i in range(p) for j in range(i, p)} | {f"b{i}": feats[i] * F.col("_y") for i in range(p)}
    x = x.withColumns({c: F.when(usable, v).otherwise(0.0) for c, v in sums.items()} | {"_pos": F.lit(1).cast("long")})
    cum = written(cumulative_sum(x, [key], [t], ["_pos", *sums]).drop("_pos", *sums).withColumnRenamed("_pos_cum", "_pos"), "running")
    fit = cum
    if window:
        old = cum.select(key, (F.col("_pos") + window).alias("_pos"), *[F.col(f"{c}_cum").alias(f"{c}_old") for c in sums])
        fit = cum.join(old, [key, "_pos"], "left").withColumns({f"{c}_cum": F.col(f"{c}_cum") - F.coalesce(f"{c}_old", F.lit(0.0)) for c in sums})
    hist = F.array(F.col("_y"), *[F.col(f"_l{i}") for i in range(1, lags)])
    ready = F.col("a0_0_cum") >= max(min_train, p)
    A = F.array(*[F.col(f"a{min(i, j)}_{max(i, j)}_cum") for i in range(p) for j in range(p)])
    fit = fit.filter(ready & ~F.exists(hist, lambda v: v.isNull())).select(key, F.col(t).alias("origin"), "_pos", A.alias("_A"),
                                                                           F.array(*[F.col(f"b{i}_cum") for i in range(p)]).alias("_b"), hist.alias("_h"))

    @F.pandas_udf("array<double>")
    def roll(A: pd.Series, b: pd.Series, hist: pd.Series) -> pd.Series:
        out = []
        for a, v, h in zip(A, b, hist):
            beta = np.linalg.lstsq(np.asarray(a, float).reshape(p, p), np.asarray(v, float), rcond=None)[0]
            h, preds = list(h), []
            for _ in range(horizon):
                preds.append(float(beta[0] + sum(beta[i] * h[i - 1] for i in range(1, p))))
                h = [preds[-1], *h[:-1]]
            out.append(preds)
        return pd.Series(out)
    made = fit.select(key, "origin", "_pos", F.posexplode(roll("_A", "_b", "_h")).alias("_i", "forecast"))
    made = made.select(key, "origin", (F.col("_i") + 1).alias("step"), (F.col("_pos") + F.col("_i") + 1).alias("_pos"), "forecast")
    actual = cum.select(key, "_pos", F.col(t).alias("target"), F.col("_y").alias("actual")).filter("actual is not null")
    return made.join(actual, [key, "_pos"]).drop("_pos").withColumn("error", F.col("actual") - F.col("forecast"))


def errors_by_step(forecasts: DataFrame, by=()) -> DataFrame:
    """M20 of the forecasts of ``rolling_origin`` per step: n, mae, mse, rmse, r2."""
    spread = F.var_pop("actual")
    return forecasts.groupBy(*by, "step").agg(F.count(F.lit(1)).alias("n"), F.avg(F.abs("error")).alias("mae"), F.avg(F.col("error") * F.col("error")).alias("mse"),
                                              F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
                                              F.when(spread > 0, 1 - F.avg(F.col("error") * F.col("error")) / spread).alias("r2"))


# O15 -----------------------------------------------------------------------
def future_months(df: DataFrame, key: str, last: str, horizon: int) -> DataFrame:
    from tadkit.functions.dates import month_start_sequence
    return df.select(key, F.posexplode(month_start_sequence(last, horizon)).alias("step", "month")).withColumn(
        "step", F.col("step") + 1)

