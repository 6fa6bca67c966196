"""The registered queries of this subpackage and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from threadwarden.llm import (
    chat_format,
    exact_dedup,
    language_id,
    merkle_manifest,
    minhash,
    mixing,
    sentencepiece_viterbi,
    sharding,
    token_alignment,
    token_blocks,
    topk_search,
    toxicity,
    url_filter,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

# The runs of characters that count as words, for DuckDB.
_WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
_LOWERED = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def query(name: str, oracle: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if oracle:
            ORACLES[name] = oracle
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query(
    "op4_exact_dedup",
    f"""
    WITH t AS (SELECT doc_id, sha256({_LOWERED}) AS text_sha256 FROM documents)
    SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
           doc_id IS NOT DISTINCT FROM max(doc_id) OVER g AS kept, text_sha256
    FROM t WINDOW g AS (PARTITION BY text_sha256)
    """,
)
def exact_dedup_query(spark, sf_dir):
    found = exact_dedup.exact_groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@query(
    "op6_mixing",
    f"""
    WITH t AS (SELECT doc_id, source, len({_WORDS})::BIGINT AS size FROM documents),
    s AS (SELECT source, sum(size)::BIGINT AS source_size FROM t GROUP BY source),
    w AS (SELECT *, [5.0::DOUBLE, 2.0::DOUBLE, 1.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS weight FROM s),
    r AS (SELECT *, row_number() OVER (ORDER BY source_size / weight, source NULLS LAST) AS nth FROM w),
    levels AS (
        -- the first sources by size per weight are full; the rest share what is left
        SELECT n.nth, ((SELECT sum(source_size) FROM r) - 3 * coalesce(sum(r.source_size) FILTER (r.nth < n.nth), 0))::DOUBLE
                      / (sum(r.weight) FILTER (r.nth >= n.nth)) AS level
        FROM r AS n, r GROUP BY n.nth),
    free AS (SELECT min(levels.nth) AS nth FROM levels JOIN r USING (nth) WHERE r.weight * levels.level <= 3 * r.source_size),
    g AS (SELECT r.source, r.source_size,
                 CASE WHEN r.nth < free.nth THEN (3 * r.source_size)::DOUBLE
                      ELSE r.weight * (SELECT level FROM levels WHERE nth = free.nth) END AS target
          FROM r, free),
    p AS (SELECT t.doc_id, t.size, g.source_size, g.target,
                 coalesce(sum(t.size) OVER (PARTITION BY t.source ORDER BY md5(t.doc_id::VARCHAR), t.doc_id
                                   ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before,
                 floor(g.target + 0.5)::BIGINT AS budget
          FROM t JOIN g ON t.source IS NOT DISTINCT FROM g.source)
    SELECT doc_id, size, source_size, target,
           CASE WHEN source_size = 0 THEN 0::BIGINT ELSE
               ((budget // source_size) * size + least(greatest(budget % source_size - before, 0), size))::BIGINT END AS taken
    FROM p
    """,
)
def mixing_query(spark, sf_dir):
    plan = mixing.plan_mix(table(spark, sf_dir, "documents"))
    plan = plan.withColumn("_position", F.array_min(F.transform("copies", lambda c: c["position"])))
    plan = plan.select("doc_id", "size", "source_size", "target", "taken", "_position")
    return mixing.in_training_order(plan, "_position", "doc_id").drop("_position")


RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
_AFTER = "CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END"


@query(
    "op7_url_filter",
    f"""
    WITH r(rh, rp, v) AS (VALUES {", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in RULES)}),
    a AS (SELECT page_id, coalesce({_AFTER}, '') AS rest FROM pages),
    p AS (SELECT page_id, rest,
                 translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                 regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path, row_number() OVER () AS n FROM a),
    m AS (SELECT p.n, arg_max(rh || rp, length(rh) * 1001 + length(rp) * 1000) AS rule, arg_max(v, length(rh) * 1001 + length(rp) * 1000) AS verdict
          FROM p JOIN r ON (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY p.n)
    SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m USING (n)
    """,
)
def url_filter_query(spark, sf_dir):
    rules = spark.createDataFrame(list(RULES), "host string, path string, verdict string")
    return url_filter.judge_pages(table(spark, sf_dir, "pages"), rules)


@query(
    "op8_topk_search",
    """
    WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(x::DOUBLE * 1024)::BIGINT) AS e FROM embeddings
               WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e::DOUBLE[], c.e::DOUBLE[])::BIGINT AS score
          FROM v AS q, v AS c WHERE q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id),
    r AS (SELECT query_id, (row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id))::INTEGER AS rank, vec_id, score FROM s)
    SELECT * FROM r WHERE rank <= 10
    """,
)
def topk_search_query(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings").filter(topk_search.usable(F.col("embedding")))
    vectors = vectors.select("vec_id", topk_search.quantised(F.col("embedding")).alias("vector"))
    return topk_search.exact_top_k(vectors, vectors.filter(F.col("vec_id") % 100 == 0), k=10)


@query(
    "op9_minhash",
    f"""
    WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.replace("coalesce(text, '')", _LOWERED)} AS w FROM documents),
    s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 1 THEN w ELSE list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]) END) AS s FROM w),
    n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s AS a JOIN s AS b USING (s) WHERE a.doc_id < b.doc_id GROUP BY ALL),
    l AS (SELECT a, b FROM p JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * i >= 80 * (x.n + y.n - i)),
    e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
    r AS (SELECT doc_id AS node, doc_id AS c FROM documents UNION SELECT e.b, r.c FROM r JOIN e ON r.node = e.a WHERE r.c < e.b),
    m AS (SELECT node AS doc_id, min(c) AS component_id FROM r GROUP BY node)
    SELECT doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
    FROM documents JOIN m USING (doc_id) LEFT JOIN n USING (doc_id)
    """,
)
def minhash_query(spark, sf_dir):
    """Two-word shingles, as the query fixes; the operator's own default is five."""
    return minhash.near_groups(table(spark, sf_dir, "documents"), minhash.Scheme(words=2))


@query("op10_token_blocks")
def token_blocks_query(spark, sf_dir):
    return token_blocks.tokenise(table(spark, sf_dir, "documents"), token_blocks.default_tokenizer())


@query("op2_language_id")
def language_id_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    held_out = language_id.fold(F.col("doc_id"), 4) == 2
    found = language_id.identify(docs, language_id.learn_profiles(docs.filter(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op5_sentencepiece")
def sentencepiece_query(spark, sf_dir):
    """Every document encoded and decoded; ids as their number and checksum."""
    docs = table(spark, sf_dir, "documents")
    return sentencepiece_viterbi.digests(sentencepiece_viterbi.encode_documents(docs, sentencepiece_viterbi.default_model()))


def toxicity_detector(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Detector:
    """Learned from labelled documents outside the held-out fold."""
    return toxicity.learn(docs, table(spark, sf_dir, "labels"), toxicity.fold(F.col("doc_id"), 3) != 1)


@query("op1_toxicity")
def toxicity_query(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    found = toxicity.score_documents(docs, toxicity_detector(spark, sf_dir, docs))
    return found.select("doc_id", (toxicity.fold(F.col("doc_id"), 3) == 1).alias("held_out"), "score", "predicted")


TRICKY = ((-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]"))
_CONTROL = r"[<\[]\\*/?(?:s>|INST\])"
_TURN_ORDER = "ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST"


@query(
    "op3_chat_format",
    f"""
    WITH c AS (SELECT conv_id, turn, role, text FROM conversations UNION ALL VALUES {", ".join(map(str, TRICKY))}),
    t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM c),
    e AS (SELECT *, replace(replace(role, chr(92), repeat(chr(92), 2)), chr(10), chr(92) || 'n') AS name FROM t)
    SELECT conv_id, count(*) AS n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' {_TURN_ORDER})) AS turns_sha256,
           coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
           sha256(coalesce(string_agg(text, '' {_TURN_ORDER}) FILTER (role = 'assistant'), '')) AS loss_sha256,
           sum(8 + length(name) + len(regexp_extract_all(name, '{_CONTROL}')) + length(text) + len(regexp_extract_all(text, '{_CONTROL}'))
               + CASE WHEN role = 'user' THEN 15 ELSE 0 END)::BIGINT AS formatted_chars
    FROM e GROUP BY conv_id
    """,
)
def chat_format_query(spark, sf_dir):
    """All conversations, and one whose texts hold control strings."""
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(list(TRICKY), "conv_id bigint, turn bigint, role string, text string"))
    found = chat_format.read_back(chat_format.format_trees(chat_format.conversation_trees(rows)))
    conv_id = F.when(F.col("tree_id") != "", F.col("tree_id").cast("bigint"))
    return found.select(conv_id.alias("conv_id"), *[c for c in found.columns if c != "tree_id"])


# The CRC-32 of a string, byte by byte: DuckDB has no function for it.
_CRC_OF_BYTE = []
for _n in range(256):
    for _ in range(8):
        _n = _n >> 1 ^ 0xEDB88320 * (_n & 1)
    _CRC_OF_BYTE.append(_n)


def _crc32(text: str) -> str:
    bytes_ = f"list_transform(regexp_extract_all(hex({text}), '..'), lambda d: ('0x' || d)::BIGINT)"
    step = f"lambda c, d: xor(c >> 8, ({_CRC_OF_BYTE}::BIGINT[])[(xor(c, d) & 255) + 1])"
    return f"CASE WHEN coalesce({text}, '') = '' THEN 0::BIGINT ELSE xor(list_reduce({bytes_}, {step}, 4294967295::BIGINT), 4294967295) END"


def _h(text: str) -> str:
    return f"coalesce(strlen({text}::VARCHAR) || ':' || {text}::VARCHAR, '-')"


_CELLS = " || ".join(_h(c) for c in ("doc_id", "source", "lang", "n_chars"))


@query(
    "op11_merkle_manifest",
    f"""
    WITH RECURSIVE d AS (
        SELECT doc_id, source, sha256({_CELLS} || {_h("text")}) AS leaf, sha256({_CELLS} || {_h("given")}) AS claim,
               row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
        FROM (SELECT *, CASE WHEN ({_crc32("doc_id::VARCHAR")}) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS given FROM documents)),
    -- the tree of every source: nodes by level, each with the number of nodes of its level
    t AS (SELECT source, 0 AS level, pos, n, leaf AS h FROM d
          UNION ALL
          SELECT source, level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos))
          FROM t WHERE n > 1 GROUP BY source, level, pos // 3),
    roots AS (SELECT source, h AS subroot, level AS top, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n
              FROM t WHERE n = 1),
    u AS (SELECT 0 AS level, place AS pos, n, subroot AS h FROM roots
          UNION ALL
          SELECT level + 1, pos // 3, any_value((n + 2) // 3), sha256(string_agg(h, '' ORDER BY pos)) FROM u WHERE n > 1 GROUP BY level, pos // 3),
    -- what stands to the left and right of every node below its parent
    b AS (SELECT x.source, x.level, x.pos, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
                 coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
          FROM t AS x LEFT JOIN t AS y ON x.source IS NOT DISTINCT FROM y.source AND x.level = y.level AND x.pos // 3 = y.pos // 3 AND x.pos <> y.pos
          WHERE x.n > 1 GROUP BY ALL),
    c AS (SELECT x.level, x.pos, coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos < x.pos), '') AS l,
                 coalesce(string_agg(y.h, '' ORDER BY y.pos) FILTER (y.pos > x.pos), '') AS r
          FROM u AS x LEFT JOIN u AS y ON x.level = y.level AND x.pos // 3 = y.pos // 3 AND x.pos <> y.pos WHERE x.n > 1 GROUP BY ALL),
    -- both parts of a path in one numbering
    path AS (SELECT d.doc_id, d.source, b.level, b.l, b.r
             FROM d JOIN b ON d.source IS NOT DISTINCT FROM b.source AND b.pos = d.pos // pow(3, b.level)::BIGINT
             UNION ALL
             SELECT d.doc_id, d.source, roots.top + c.level, c.l, c.r
             FROM d JOIN roots ON d.source IS NOT DISTINCT FROM roots.source JOIN c ON c.pos = roots.place // pow(3, c.level)::BIGINT),
    paths AS (SELECT doc_id, source, list({{'l': l, 'r': r}} ORDER BY level) AS p FROM path GROUP BY doc_id, source),
    f AS (SELECT d.*, roots.subroot, (SELECT h FROM u WHERE n = 1) AS root, coalesce(paths.p, []) AS p
          FROM d JOIN roots ON d.source IS NOT DISTINCT FROM roots.source
          LEFT JOIN paths ON d.doc_id IS NOT DISTINCT FROM paths.doc_id AND d.source IS NOT DISTINCT FROM paths.source),
    g AS (SELECT *, list_reduce(list_transform(p, lambda x: x.l || ',' || x.r), lambda h, x: sha256(replace(x, ',', h)), claim) AS folded_root FROM f)
    SELECT doc_id, leaf, subroot, root, sha256(array_to_string(list_transform(p, lambda x: x.l || x.r), '')) AS proof_sha256,
           folded_root, folded_root = root AS verified
    FROM g
    """,
)
def merkle_query(spark, sf_dir):
    """Every second document, by a hash of its id, is checked without its line breaks."""
    docs = table(spark, sf_dir, "documents")
    tampered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    given = F.when(tampered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return merkle_manifest.manifest(docs, given).drop("source")


@query(
    "op12_sharding",
    f"""
    WITH k AS (SELECT doc_id, source, coalesce(strlen(text), 0) + 1 AS size, {_crc32("text")} AS text_crc32,
                      ('0x' || md5('0:' || coalesce(doc_id::VARCHAR, ''))[1:15])::BIGINT AS key FROM documents),
    r AS (SELECT *, (row_number() OVER (PARTITION BY source ORDER BY key, doc_id NULLS FIRST) - 0.5::DOUBLE)
                    / count(*) OVER (PARTITION BY source) AS fraction FROM k),
    p AS (SELECT *, row_number() OVER (ORDER BY fraction, key, doc_id NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM r)
    SELECT doc_id, size, text_crc32, 'rows' AS law, (pos * 16 // n)::INTEGER AS shard,
           pos - ((pos * 16 // n) * n + 15) // 16 AS slot, NULL::INTEGER AS grown_shard
    FROM p
    """,
)
def sharding_query(spark, sf_dir):
    """Sixteen shards, written and read back; what is returned is derived from what stands in them."""
    text = F.coalesce("row.text", F.lit(""))
    return sharding.shard_documents(table(spark, sf_dir, "documents")).select(
        F.col("row.doc_id").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
        F.lit("rows").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


@query("op13_token_alignment")
def token_alignment_query(spark, sf_dir):
    return token_alignment.align_documents(table(spark, sf_dir, "documents"), *token_alignment.default_tokenizers())
