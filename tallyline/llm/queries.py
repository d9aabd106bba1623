"""The queries of the operators, and their SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.llm import bpe, chat, html_crf, jaccard, knn_quality, langmix, leaks, periodic, phrases, pii, repetition, ring, url_lm
from tallyline.llm.common import fold, table
from tallyline.operators.pin import pin


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document, and the text decoded from them, as digests."""
    import public_tokenizers

    tokenizer = bpe.Tokenizer(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    encoded = docs.select("doc_id", tokenizer.encode("text").alias("ids"))
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " ").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(tokenizer.decode("ids"), 256).alias("decoded_sha256"),
    )


def op7_language_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from the folds that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text", "lang")
    held_out = fold("doc_id", 4) == 2
    model = langmix.fit(docs.where(~held_out), "text", "lang", "doc_id")
    found = docs.select("doc_id", held_out.alias("held_out"), langmix.predict(model, spark, "text").alias("found"))
    return found.select("doc_id", "held_out", "found.lang_pred", "found.score", "found.langs", "found.shares")


def op1_crf_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The main text of every page."""
    pages = table(spark, sf_dir, "pages", "page_id", "url", "html")
    model = html_crf.fit(pages, "html", "page_id")
    found = pages.select("page_id", "url", html_crf.main_text(model, spark, "html").alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op2_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for the personal data in its text."""
    return pii.replace(table(spark, sf_dir, "documents", "doc_id", "text"))


def op3_suffix_repetition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Repetition counts of every document and the verdict."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", repetition.measures("text").alias("m"))
    failed, kept = repetition.verdict("m")
    return docs.select("doc_id", "m.*", failed.alias("base_failed"), kept.alias("kept"))


def op4_hash_ring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards of all documents, by the law of rows."""
    placed = ring.assign(spark, table(spark, sf_dir, "documents", "doc_id", "text"), 40)
    return placed.select(
        F.col("id").alias("doc_id"),
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


#: The rules of the URL filter and what each says.
URL_RULES = [
    ("org/", "allow"),
    ("example.org/es/", "block"),
    ("example.org/en/1", "block"),
    ("com/fr/", "allow"),
    ("com/de/", "block"),
]


def op5_url_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every URL, by the rules or by the ratio of the language models."""
    judged = url_lm.judge(table(spark, sf_dir, "pages", "page_id", "url"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict", "score")


def op6_neighbour_votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned from the labels that are not held out."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    held_out = fold("doc_id", 5) == 0
    labels = table(spark, sf_dir, "labels", "doc_id", "quality").where(~held_out)
    model = knn_quality.fit(docs, labels, "doc_id", "text", "quality")
    scored = docs.select("doc_id", held_out.alias("held_out"), knn_quality.scores(model, spark, "text").alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op8_jaccard_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The component of every document under links of Jaccard 0.9 over three words."""
    found = jaccard.similar(table(spark, sf_dir, "documents", "doc_id", "text"), n=3, num=90, den=100)
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op10_bm25_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that a test item leaks into, with the item."""
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    found = leaks.leaks(docs, table(spark, sf_dir, "benchmark", "item_id", "text"))
    return found.withColumnRenamed("id", "doc_id")


def _planted(doc_id: str, text: str) -> Column:
    """The text with a period written into it where the id's checksum ends in 0, else as it is."""
    h = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    g = F.floor(h / 10)

    def write(words: Column) -> Column:
        n = F.size(words).cast("long")
        a = g % n
        p = 1 + F.floor((n - a) / (3 + g % 8))
        place = lambda i: F.when(i < a, i).otherwise(a + (i - a) % p).cast("int")
        return F.array_join(F.transform(F.sequence(F.lit(0), F.size(words) - 1), lambda i: F.get(words, place(i))), " ")

    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    # The words are bound once, as a variable; written out they would be split again for each of them.
    made = F.transform(F.array(words), lambda w: F.when(F.size(w) > 0, write(w)).otherwise(F.lit("")))[0]
    return F.when((h % 10 == 0) & F.col(text).isNotNull(), made).otherwise(F.col(text))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The periodic runs of every document, after periods were planted in a tenth of them.

    A document without an id is not planted.
    """
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    # The text is made before the operator reads it: Spark takes no lambda in a Python function's argument.
    made = pin(docs, "text", _planted("doc_id", "text"))
    found = made.select("doc_id", periodic.periodic("text").alias("m"))
    best = found.select("doc_id", "m", periodic.longest(F.col("m.runs")).alias("best"))
    return best.select(
        "doc_id",
        F.size("m.runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(periodic.listed(F.col("m.runs")).cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("m.collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def op12_budgeted_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation as it is read back from its formatted windows.

    The digests are those of whole conversations, so the texts of one come together here; the operator
    itself never needs that.
    """
    given = table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text")
    marks = F.lit("<|im_end|><|im_start|>assistant ok")
    role = F.when(F.col("id") == 0, "user").otherwise("assistant")
    added = spark.range(2).select(F.lit(-1).cast("long").alias("conv_id"), F.col("id").alias("turn"), role.alias("role"), marks.alias("text"))
    found = chat.windows(given.unionByName(added)).withColumns(
        {
            "turns": chat.read_turns(F.col("formatted"), F.col("n_repeated")),
            "learned": F.array_join(chat.read_loss(F.col("formatted"), F.col("loss")), ""),
        }
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    part = F.struct(
        "window",
        lines.alias("lines"),
        "learned",
        F.size("turns").cast("long").alias("n"),
        F.length("formatted").cast("long").alias("chars"),
    )
    whole = found.groupBy("conv_id").agg(F.sort_array(F.collect_list(part)).alias("parts"), F.count("*").alias("n_windows"))
    text = lambda name: F.array_join(F.transform("parts", lambda p: p[name]), "")
    total = lambda name: F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p[name])
    return whole.select(
        "conv_id",
        total("n").alias("n_turns"),
        F.sha2(text("lines").cast("binary"), 256).alias("turns_sha256"),
        F.length(text("learned")).cast("long").alias("loss_chars"),
        F.sha2(text("learned").cast("binary"), 256).alias("loss_sha256"),
        total("chars").alias("formatted_chars"),
        "n_windows",
    )


def op13_phrase_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first 2,000 collocations of every language."""
    found = phrases.frequent(table(spark, sf_dir, "documents", "lang", "text"))
    best = phrases.top(phrases.collocations(found))
    return best.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_crf_blocks": op1_crf_blocks,
    "op2_surrogates": op2_surrogates,
    "op3_suffix_repetition": op3_suffix_repetition,
    "op4_hash_ring": op4_hash_ring,
    "op5_url_ratio": op5_url_ratio,
    "op6_neighbour_votes": op6_neighbour_votes,
    "op7_language_mixture": op7_language_mixture,
    "op8_jaccard_regions": op8_jaccard_regions,
    "op9_byte_bpe": op9_byte_bpe,
    "op10_bm25_leaks": op10_bm25_leaks,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_budgeted_windows": op12_budgeted_windows,
    "op13_phrase_collocations": op13_phrase_collocations,
}

#: SQL for those that SQL can express.
ORACLES: dict[str, str] = {
    "op13_phrase_collocations": r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), words AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM pieces),
sized AS (SELECT lang, w, k FROM words, range(1, 6) t(k) WHERE len(w) >= k),
spots AS (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM sized),
f AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase, count(*) AS f FROM spots GROUP BY ALL HAVING f >= 100
), totals AS (SELECT lang, sum(len(w)) AS n FROM words GROUP BY lang),
parts AS (SELECT *, string_split(phrase, ' ') AS w FROM f),
longer AS (
  SELECT lang, array_to_string(w[1 : k - 1], ' ') AS phrase, f FROM parts WHERE k > 2
  UNION SELECT lang, array_to_string(w[2 : k], ' '), f FROM parts WHERE k > 2
), kept AS (SELECT * FROM parts WHERE k > 1 AND (lang, phrase, f) NOT IN (SELECT lang, phrase, f FROM longer)),
cuts AS (
  SELECT lang, phrase, f AS a, j, array_to_string(w[1 : j], ' ') AS head, array_to_string(w[j + 1 : k], ' ') AS tail
  FROM (SELECT *, unnest(range(1, k)) AS j FROM kept)
), scored AS (
  SELECT c.lang, c.phrase, a, j, h.f AS l, t.f AS r, n,
    CAST(1000 * CAST(a AS HUGEINT) * n // (CAST(h.f AS HUGEINT) * t.f) AS BIGINT) AS score
  FROM cuts c JOIN f h ON h.lang = c.lang AND h.phrase = head JOIN f t ON t.lang = c.lang AND t.phrase = tail
  JOIN totals s ON s.lang = c.lang
), best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r,
  CAST(n AS BIGINT) AS n, score
FROM best QUALIFY rank <= 2000""",
}
