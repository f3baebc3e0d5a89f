"""Queries of the training-data operators over the given tables, and their SQL."""

from __future__ import annotations


from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veridq.llm.common import read


def tokenizer(name: str) -> str:
    """Path of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Encode and decode every text; digests of ids and of the decoded text."""
    from veridq.llm import bpe

    path = tokenizer("byte_bpe_50k.json")
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    back = bpe.decode(bpe.encode(docs, path), path, text="decoded")
    return back.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of every document with their place in a sequence."""
    from veridq.llm import packing

    return packing.pack_documents(read(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group and the line to keep for every line of every document."""
    from veridq.llm import linededup

    return linededup.line_rows(read(spark, sf_dir, "documents"))


def op3_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from veridq.llm import htmlcrf

    return htmlcrf.extract(read(spark, sf_dir, "pages"))


def op5_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Maximal conversations, rendered."""
    from veridq.llm import chat

    return chat.render(read(spark, sf_dir, "conversations"))


def op6_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every text and its edited text, and how alike they are."""
    from veridq.llm import winnow

    got = winnow.edited(read(spark, sf_dir, "documents"))
    return got.select(
        "doc_id",
        F.col("n_chars").cast("long").alias("n_chars"),
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        winnow.digest("e").alias("fingerprint"),
        winnow.digest("ee").alias("edited_fingerprint"),
        winnow.likeness("e", "ee").alias("near_edited"),
        winnow.likeness("e", "ne").alias("near_next"),
    )


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    from veridq.llm import gam

    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = gam.fit(docs, read(spark, sf_dir, "labels"))
    scored = gam.score(docs, model)
    return scored.select("doc_id", gam.held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Group, size and the row to keep for every document."""
    from veridq.llm import exact

    return exact.dedup(read(spark, sf_dir, "documents")).drop("row")


def op9_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document through the compressed token files."""
    from veridq.llm import tokenfile

    return tokenfile.round_trip(read(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Component of near duplicates for every document."""
    from veridq.llm import setsketch

    return setsketch.near_duplicates(read(spark, sf_dir, "documents"))


def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of each language, with exact counts."""
    from veridq.llm import collocations

    return collocations.collocations(read(spark, sf_dir, "documents"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whitened components of every embedding."""
    from veridq.llm import whitening

    return whitening.whiten(read(spark, sf_dir, "embeddings"))


#: Rules of ``op13_url_filter``: host, path, whether it allows.
URL_RULES = [("org", "/", True), ("example.org", "/es/", False), ("example.org", "/en/1", False), ("com", "/fr/", True), ("com", "/de/", False)]


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on every page's URL by rules and redirect equivalence."""
    from veridq.llm import urlfilter

    return urlfilter.judge(read(spark, sf_dir, "pages"), spark.createDataFrame(URL_RULES, urlfilter.RULE))


def all_queries() -> dict:
    return {
        "op1_bpe": op1_bpe,
        "op4_packing": op4_packing,
        "op2_line_dedup": op2_line_dedup,
        "op3_html": op3_html,
        "op5_chat": op5_chat,
        "op6_fingerprints": op6_fingerprints,
        "op7_quality": op7_quality,
        "op8_exact_dedup": op8_exact_dedup,
        "op9_tokens": op9_tokens,
        "op10_near_dedup": op10_near_dedup,
        "op11_collocations": op11_collocations,
        "op12_whitening": op12_whitening,
        "op13_url_filter": op13_url_filter,
    }


def all_sql() -> dict[str, str]:
    return {"op5_chat": SQL_CHAT, "op8_exact_dedup": SQL_EXACT, "op11_collocations": SQL_COLLOCATIONS, "op13_url_filter": SQL_URLS}


SQL_EXACT = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY t) AS keep_id,
       count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept,
       sha256(t) AS text_sha256
FROM d
"""

# Conversations as lists of turns; one goes if it is the head of a longer one, or equals one
# with a smaller id.
SQL_CHAT = """
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations
),
c AS (
  SELECT conv_id, count(*) AS n, list('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10) ORDER BY pos) AS turns
  FROM t GROUP BY conv_id
),
gone AS (
  SELECT a.conv_id FROM c a JOIN c b ON a.turns[1] = b.turns[1] AND a.conv_id <> b.conv_id
  WHERE a.turns = b.turns[1:a.n] AND (b.n > a.n OR b.conv_id < a.conv_id)
),
k AS (SELECT c.* FROM c ANTI JOIN gone USING (conv_id)),
p AS (SELECT conv_id, n, turns, unnest(range(0, (n + 1023) // 1024)) AS part FROM k)
SELECT conv_id, part, n AS n_turns, array_to_string(turns[part * 1024 + 1 : part * 1024 + 1024], '') AS text FROM p
"""

# Every n-gram of every piece, counted plainly.
SQL_COLLOCATIONS = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang,
         unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
w AS (SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]'), lambda x: x <> '') AS w FROM pieces),
totals AS (SELECT lang, sum(len(w))::HUGEINT AS n FROM w GROUP BY lang),
lens AS (SELECT unnest([1, 2, 3, 4, 5]) AS m),
starts AS (SELECT lang, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM w, lens WHERE len(w) >= m),
f AS (
  SELECT lang, m, w[i : i + m - 1] AS p, count(*)::HUGEINT AS f
  FROM starts GROUP BY ALL
  HAVING count(*) >= 100
),
cuts AS (SELECT lang, m, p, f AS a, unnest(range(1, m)) AS k FROM f WHERE m > 1),
scored AS (
  SELECT c.lang, c.p, c.a, c.k, x.f AS l, y.f AS r, t.n, (1000 * c.a * t.n) // (x.f * y.f) AS score
  FROM cuts c
  JOIN f x ON x.lang = c.lang AND x.p = c.p[1 : c.k]
  JOIN f y ON y.lang = c.lang AND y.p = c.p[c.k + 1 : c.m]
  JOIN totals t ON t.lang = c.lang
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1),
inner_ AS (SELECT lang, m, f, p, unnest(range(2, m)) AS len FROM f WHERE m > 2),
parts AS (SELECT lang, f, p, m, len, unnest(range(1, m - len + 2)) AS i FROM inner_),
inside AS (SELECT lang, p[i : i + len - 1] AS p, max(f) AS longer FROM parts GROUP BY ALL),
kept AS (
  SELECT b.*, array_to_string(b.p, ' ') AS phrase FROM best b LEFT JOIN inside s ON s.lang = b.lang AND s.p = b.p
  WHERE s.longer IS NULL OR s.longer < b.a
)
SELECT lang, rank, phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
WHERE rank <= 2000
"""

# Rules, then blocks along absolute canonical links and refreshes in the heads (tests compare
# relative ones with brute force).
SQL_URLS = r"""
WITH RECURSIVE rules(r_host, r_path, r_verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
),
p AS (SELECT page_id, row_number() OVER () AS row_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
tags AS (
  SELECT url, unnest(regexp_extract_all(regexp_replace(regexp_replace(html, '(?is)<!--.*?(-->|$)', ' ', 'g'), '(?is)<body\b.*', ''), '(?is)<(?:link|meta)\b[^>]*>')) AS tag FROM p
),
links AS (
  SELECT url AS a, regexp_extract(tag, '(?is)https?://[^"''\s>]*') AS b FROM tags
  WHERE regexp_matches(tag, '(?is)rel\s*=\s*["'']?canonical') OR regexp_matches(tag, '(?is)http-equiv\s*=\s*["'']?refresh')
),
urls AS (SELECT url FROM p UNION SELECT b FROM links),
parts AS (
  SELECT url,
         translate(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2) AS path,
         regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)(\??[^#]*)', 3) AS query
  FROM urls
),
named AS (SELECT *, CASE WHEN host <> '' THEN host || CASE WHEN path = '' THEN '/' ELSE path END || CASE WHEN query = '?' THEN '' ELSE query END END AS key FROM parts),
ruled AS (
  SELECT n.*, r.r_host || r.r_path AS rule, r.r_verdict
  FROM named n LEFT JOIN rules r ON (n.host = r.r_host OR ends_with(n.host, '.' || r.r_host)) AND starts_with(n.path, r.r_path)
  QUALIFY row_number() OVER (PARTITION BY n.url ORDER BY length(r.r_host || r.r_path) DESC NULLS LAST) = 1
),
edges AS (
  SELECT x.key AS a, y.key AS b FROM links JOIN named x ON x.url = links.a JOIN named y ON y.url = links.b WHERE x.key IS NOT NULL AND y.key IS NOT NULL
),
both_ways AS (SELECT a, b FROM edges UNION SELECT b, a FROM edges),
bad(key) AS (
  SELECT DISTINCT key FROM ruled WHERE r_verdict = 'block' AND key IN (SELECT a FROM both_ways)
  UNION
  SELECT e.b FROM bad JOIN both_ways e ON e.a = bad.key
)
SELECT p.page_id, u.host, u.path, u.rule,
       coalesce(u.r_verdict, CASE WHEN u.key IN (SELECT key FROM bad) THEN 'block' ELSE 'allow' END) AS verdict
FROM p JOIN ruled u ON u.url = p.url
"""
