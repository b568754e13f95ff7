"""The dealt operators as queries over whole tables, with their DuckDB statements.

Each query derives the columns of its contract from the operator's own output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from hitledger.llm import (
    decontamination,
    exact_dedup,
    language_id,
    lm_scoring,
    near_dedup,
    packing,
    quality,
    quality_rules,
    token_files,
    url_filter,
    variants,
    warc,
    whitening,
)
from hitledger.llm.common import crc_remainder, ready, saved, shared_folder
from hitledger.llm.url_filter import HostRule

Query = Callable[[SparkSession, str], DataFrame]

# The rules of the URL filter's contract.
URL_RULES = [
    HostRule("org", "/", "allow"),
    HostRule("example.org", "/es/", "block"),
    HostRule("example.org", "/en/1", "block"),
    HostRule("com", "/fr/", "allow"),
    HostRule("com", "/de/", "block"),
]


BYTE_TOKENIZER = ("byte_bpe_50k.json", "spaces")
WORD_TOKENIZER = ("word_bpe_49k.json", "words")


def tokenizer_path(name: str) -> str:
    """Where the public tokenizers of this machine are, the same on all of them."""
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontamination.contamination_report(documents, table(spark, sf_dir, "benchmark"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; labels come from those with a crc32 that 5 does not divide."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = crc_remainder(F.col("doc_id"), 5)
    labels = table(spark, sf_dir, "labels").where(remainder != 0)
    forest = quality.train(documents, labels.select("doc_id", F.col("quality").alias("label")))
    return quality.scored(documents, forest).select(
        "doc_id",
        (remainder == 0).alias("held_out"),
        "score",
        (F.col("score") >= 0.3).cast("int").alias("predicted"),
    )


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_dedup.near_duplicates(documents, size=2, percent=80).drop("text_hash")


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents written as token files and read back."""
    name, borders = BYTE_TOKENIZER
    path = shared_folder(spark, "tokens")
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    token_files.write_token_files(documents, path, tokenizer_path(name), borders)
    return token_files.read_token_files(spark, path)


def op5_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages judged by explicit rules, then by rules mined from labelled documents.

    The number that ends a page's path is the document it shows; a document of low
    quality or marked toxic labels the page as one to block.
    """
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    shown = F.regexp_extract(url_filter.url_path(F.col("url")), r"(\d{1,18})[^\d]*$", 1)
    blocked = (F.col("quality") == 0) | (F.col("toxic") == 1)
    labels = table(spark, sf_dir, "labels").select("doc_id", blocked.alias("blocked"))
    labelled = (
        pages.select("url", shown.try_cast("long").alias("shown"))
        .join(labels, F.col("shown") == F.col("doc_id"))
        .select("url", "blocked")
    )
    mined = url_filter.mine_rules(labelled)
    return url_filter.filter_urls(pages, mined, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict"
    )


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of all documents; the model is learnt from those with another remainder than 2."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    remainder = crc_remainder(F.col("doc_id"), 7)
    return lm_scoring.scores(documents, remainder != 2).select(
        "doc_id",
        (remainder == 2).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    name, borders = WORD_TOKENIZER
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.packed(packing.pieces(documents, tokenizer_path(name), borders))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.dedup_report(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages written as archives and read back, one row per capture and copy."""
    path = shared_folder(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    read = warc.captures(warc.read_records(spark, path)).where("response is not null")
    page = F.regexp_extract("metadata.fields", r"(?m)^page-id: (-?\d+)$", 1).try_cast("long")
    found = saved(read.select(page.alias("page_id"), "copies", "response.*"), "warc-captures")
    original = found.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"),
        F.col("page_id").alias("first_page"),
        F.col("payload_bytes").alias("first_bytes"),
        F.col("payload_digest").alias("first_digest"),
    )
    return (
        found.join(original, "refers_to", "left")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
        .select(
            "page_id",
            F.coalesce("payload_bytes", "first_bytes").alias("payload_bytes"),
            F.coalesce("payload_digest", "first_digest").alias("payload_digest"),
            "record_type",
            F.col("first_page").alias("refers_to"),
        )
    )


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    remainder = crc_remainder(F.col("doc_id"), 5)
    model = language_id.train(documents, remainder != 0)
    found = language_id.identified(documents, model, keep=["doc_id"])
    return found.select(
        "doc_id",
        (remainder == 0).alias("held_out"),
        F.col("language.name").alias("lang_pred"),
        F.col("language.score").alias("score"),
    )


def op11_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = quality_rules.judged(documents, ["doc_id"]).select("doc_id", "quality.*")
    return found.drop("n_lines", "n_stop_words", "n_upper_words")


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return variants.spelling_variants(documents)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row for each vector and component; a deviation beyond 64 bits is null."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    found = whitening.whitened(vectors).select("vec_id", "whitening.*")
    one = F.posexplode(F.arrays_zip("whitened", "explained")).alias("place", "value")
    return found.select("vec_id", "n", "deviation", "identity_error", one).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        F.col("deviation").try_cast("long").alias("deviation"),
        F.col("value.whitened").alias("whitened"),
        F.col("value.explained").alias("explained"),
        "identity_error",
    )


QUERIES: dict[str, Query] = {
    "op1_decontamination": op1_decontamination,
    "op2_quality": op2_quality,
    "op3_near_dedup": op3_near_dedup,
    "op4_token_files": op4_token_files,
    "op5_url_filter": op5_url_filter,
    "op6_lm_scoring": op6_lm_scoring,
    "op7_packing": op7_packing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_warc": op9_warc,
    "op10_language_id": op10_language_id,
    "op11_quality_rules": op11_quality_rules,
    "op12_spelling_variants": op12_spelling_variants,
    "op13_whitening": op13_whitening,
}

_WHITE = r"[\x20\x09-\x0D]+"

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _word_list(pattern: str) -> str:
    """The words of `text` in DuckDB, A-Z in lower case."""
    lowered = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"
    return f"regexp_extract_all({lowered}, '{pattern}')"


_PLAIN_WORDS = _word_list(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_WHITE_WORDS = _word_list(r"[^\x20\x09-\x0D]+")

_STOP_WORDS = ", ".join(f"'{w}'" for w in quality_rules.STOP_WORDS)


def _rule_sql(r: quality_rules.Rule) -> str:
    least = "" if r.least is None else f" AND 100 * {r.part} >= {r.least} * {r.whole}"
    most = "" if r.most is None else f" AND 100 * {r.part} <= {r.most} * {r.whole}"
    return f"({r.whole} = 0 OR (true{least}{most}))"


_RULE_COLUMNS = ", ".join(f"{_rule_sql(r)} AS rule_{r.name}" for r in quality_rules.RULES)
_ALL_RULES = " AND ".join(map(_rule_sql, quality_rules.RULES))

ORACLE_SQL: dict[str, str] = {
    "op1_decontamination": f"""
        WITH docs AS (
            SELECT doc_id, {_PLAIN_WORDS} AS w FROM documents
        ), items AS (
            SELECT item_id, {_PLAIN_WORDS} AS w FROM benchmark
        ), windows AS (
            SELECT item_id, least(len(w), 10) AS size,
                   array_to_string(w[i : i + 9], ' ') AS gram
            FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(i)
            WHERE len(w) > 0
        ), sizes AS (
            SELECT DISTINCT size FROM windows
        ), grams AS (
            SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS gram
            FROM docs, sizes, unnest(range(1, len(w) - size + 2)) AS t(i)
        ), hits AS (
            SELECT doc_id, i, size, item_id FROM grams JOIN windows USING (size, gram)
        ), words AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM hits, unnest(range(i, i + size)) AS t(p) GROUP BY doc_id
        ), found AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items,
                   string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM hits GROUP BY doc_id
        )
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
               coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
               coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN words USING (doc_id) LEFT JOIN found USING (doc_id)
    """,
    "op3_near_dedup": f"""
        WITH RECURSIVE docs AS (
            SELECT doc_id, {_WHITE_WORDS} AS w FROM documents
        ), shingles AS (
            SELECT DISTINCT doc_id, array_to_string(w[i : i + 1], ' ') AS s
            FROM docs, unnest(range(1, greatest(len(w) - 1, 1) + 1)) AS t(i)
            WHERE len(w) > 0
        ), sizes AS (
            SELECT doc_id, count(s) AS n FROM docs LEFT JOIN shingles USING (doc_id) GROUP BY doc_id
        ), shared AS (
            SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
            FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id
            GROUP BY a, b
        ), links AS (
            SELECT a, b FROM shared
            JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
            WHERE 100 * shared.n >= 80 * (p.n + q.n - shared.n)
        ), reach AS (
            SELECT doc_id AS a, doc_id AS b FROM docs
            UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
        ), components AS (
            SELECT a AS doc_id, min(b) AS component_id FROM reach GROUP BY a
        )
        SELECT doc_id, n AS n_shingles, component_id, doc_id = component_id AS kept
        FROM sizes JOIN components USING (doc_id)
    """,
    "op8_exact_dedup": rf"""
        WITH rows AS (
            SELECT doc_id, length(coalesce(text, '')) AS n,
                   sha256(regexp_replace(coalesce(text, ''), '{_WHITE}', '', 'g')) AS sha
            FROM documents
        ), groups AS (
            SELECT doc_id, sha,
                   first_value(doc_id) OVER (PARTITION BY sha ORDER BY n DESC, doc_id) AS keep_id,
                   count(*) OVER (PARTITION BY sha) AS group_size
            FROM rows
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha AS text_sha256
        FROM groups
    """,
    "op9_warc": """
        WITH rows AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
                   sha1(coalesce(html, '')) AS payload_digest
            FROM pages
        ), firsts AS (
            SELECT *, CASE WHEN payload_bytes >= 1000 THEN
                   max(page_id) OVER (PARTITION BY payload_digest) ELSE page_id END AS first_page
            FROM rows
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_page THEN first_page END AS refers_to
        FROM firsts
    """,
    "op11_quality_rules": rf"""
        WITH docs AS (
            SELECT doc_id, coalesce(text, '') AS t,
                   regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
                   [x FOR x IN string_split(coalesce(text, ''), chr(10))
                    IF regexp_matches(x, '[^\x20\x09-\x0D]')] AS l
            FROM documents
        ), windows AS (
            SELECT doc_id, i, array_to_string(w[i : i + 2], ' ') AS gram
            FROM docs, unnest(range(1, len(w) - 1)) AS t(i)
        ), again AS (
            SELECT doc_id, i FROM windows
            QUALIFY count(*) OVER (PARTITION BY doc_id, gram) > 1
        ), repeats AS (
            SELECT doc_id, count(DISTINCT p) AS n_repeat_words
            FROM again, unnest(range(i, i + 3)) AS t(p) GROUP BY doc_id
        ), counts AS (
            SELECT doc_id, len(w)::BIGINT AS n_words,
                   length(array_to_string(w, ''))::BIGINT AS word_chars,
                   length(regexp_replace(t, '[^{quality_rules.SYMBOLS}]', '', 'g'))::BIGINT AS n_symbols,
                   len(l) AS n_lines, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
                   coalesce(n_repeat_words, 0)::BIGINT AS n_repeat_words,
                   len([x FOR x IN w IF lower(x) IN ({_STOP_WORDS})]) AS n_stop_words,
                   len([x FOR x IN w IF regexp_matches(x, '[A-Z]{{2}}')
                        AND NOT regexp_matches(x, '[a-z]')]) AS n_upper_words
            FROM docs LEFT JOIN repeats USING (doc_id)
        ), judged AS (
            SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts
        )
        SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               {_RULE_COLUMNS}, NOT base_failed AND {_ALL_RULES} AS kept
        FROM judged
    """,
    "op12_spelling_variants": f"""
        WITH RECURSIVE crc_steps(i, k, c) AS (
            SELECT i, 0, i FROM range(256) AS t(i)
            UNION ALL
            SELECT i, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END
            FROM crc_steps WHERE k < 8
        ), crc_table AS (
            SELECT i, c AS code FROM crc_steps WHERE k = 8
        ), runs AS (
            SELECT doc_id, run, count(*) AS n FROM (
                SELECT doc_id, unnest(regexp_extract_all(
                    translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[A-Za-zÀ-ÿ]{{7,}}')) AS run
                FROM documents) GROUP BY doc_id, run
        ), walk(run, n, h, p, c) AS (
            SELECT run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)), 0, 4294967295
            FROM runs
            UNION ALL
            SELECT run, n, h, p + 1, xor(c >> 8, code) FROM walk JOIN crc_table
            ON i = xor(c & 255, 16 * (strpos('0123456789ABCDEF', substr(h, 2 * p + 1, 1)) - 1)
                                + strpos('0123456789ABCDEF', substr(h, 2 * p + 2, 1)) - 1)
            WHERE 2 * p < length(h)
        ), hashed AS (
            SELECT run, n, xor(c, 4294967295) AS crc FROM walk WHERE 2 * p = length(h)
        ), changed AS (
            SELECT n, CASE WHEN crc % 31 <> 0 THEN run
                   ELSE substr(run, 1, (crc % length(run))::BIGINT)
                        || substr(run, (crc % length(run))::BIGINT + 2) END AS word
            FROM hashed
        ), words AS (
            SELECT word, sum(n)::BIGINT AS n FROM changed WHERE length(word) >= 7
            GROUP BY word HAVING sum(n) >= 2
        ), shorter AS (
            SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
            FROM words, unnest(range(1, length(word) + 1)) AS t(i)
        ), near AS (
            SELECT a.word, b.word AS other FROM shorter a JOIN shorter b USING (rest, i)
            WHERE a.word <> b.word
            UNION SELECT s.word, w.word FROM shorter s JOIN words w ON s.rest = w.word
            UNION SELECT w.word, s.word FROM shorter s JOIN words w ON s.rest = w.word
        ), ranked AS (
            SELECT near.word, other, n,
                   row_number() OVER (PARTITION BY near.word ORDER BY n DESC, other) AS place,
                   count(*) OVER (PARTITION BY near.word) AS n_near
            FROM near JOIN words ON words.word = other
        ), found AS (
            SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
                   CASE WHEN r.n >= 10 * w.n THEN other END AS form,
                   CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
            FROM words w LEFT JOIN ranked r ON r.word = w.word AND place = 1
        ), ways(word, reached) AS (
            SELECT word, word FROM found
            UNION ALL
            SELECT ways.word, form FROM ways JOIN found ON found.word = reached WHERE form IS NOT NULL
        )
        SELECT f.word, f.n, f.n_near, f.form, f.form_n, reached AS root
        FROM found f JOIN ways ON ways.word = f.word
        JOIN found e ON e.word = reached AND e.form IS NULL
    """,
}
