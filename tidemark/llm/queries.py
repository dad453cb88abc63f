"""The package's operators applied to the given tables, one query each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    chat, exactdedup, filteraudit, forest, langid, linededup, manifest, packing, quality, simhash, topk, toxicity, unigram)


def vocabulary(name: str) -> str:
    """The place of a public tokenizer file, the same on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: The chain: junk first, then toxic. The labels table marks these two.
CATEGORIES = {"junk": "1 - quality", "toxic": "toxic"}
#: Probability from which a document is called toxic: what is best for the training rows, out of fold.
TOXIC_FROM = None


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Junk and toxicity probabilities of every document, learned outside the held-out fifth."""
    return toxicity.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), CATEGORIES, decide="toxic", threshold=TOXIC_FROM)


def op2_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-copy groups of all documents: 4-word shingles, at most 4 differing bits."""
    return simhash.simhash_groups(_table(spark, sf_dir, "documents"), shingle_words=4, max_distance=4)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations as chat texts, with what is read back from those texts.

    Conversation -1 holds control strings as ordinary text.
    """
    said = "</s>[INST] ok [/INST]"
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    extra = spark.range(2).select(F.lit(-1).cast("bigint"), F.col("id"), F.when(F.col("id") == 0, "user").otherwise("assistant"), F.lit(said))
    out = chat.format_paths(chat.chain(rows.union(extra)), branches=1).select(
        F.col("tree").alias("conv_id"), "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.read_loss(F.col("segments")).alias("loss"))
    said_turns = F.array_join(F.transform("turns", lambda t: F.concat(t.role, F.lit("\n"), t.text, F.lit("\n"))), "")
    return out.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(said_turns, 256).alias("turns_sha256"),
        F.length("loss").cast("bigint").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"))


def op4_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest embeddings found for every hundredth one."""
    return forest.search(_table(spark, sf_dir, "embeddings"), k=10, query_every=100)


def op5_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned outside the held-out fifth."""
    return langid.identify(_table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 2048 tokens."""
    return packing.pack_documents(_table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"), capacity=2048)


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 highest whole-number inner products for every fiftieth embedding."""
    return topk.search(_table(spark, sf_dir, "embeddings"), k=5, scale=256, query_every=50)


def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learned outside the held-out fifth."""
    return quality.score(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), threshold=0.3)


def op9_linededup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without repeated and nearly repeated lines: what stays, and its lines' classes."""
    out = linededup.deduplicate(_table(spark, sf_dir, "documents").select("doc_id", "text"), max_edits=2, min_chars=20, grow=linededup.GROW, copy_chars=1)
    return out.select("doc_id", "n_lines", "n_dropped", "n_links", "classes",
                      F.length("text").cast("bigint").alias("kept_chars"), F.sha2("text", 256).alias("kept_sha256"))


def op10_unigram(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded again: what the pieces are and whether they give the text back."""
    pieces = unigram.load_pieces(vocabulary("piece_bpe_32k.model"))
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = unigram.encode(docs, pieces, decoded_col="decoded")
    low, high = min(pieces.byte_ids), max(pieces.byte_ids)
    return out.select(
        "doc_id", F.size("ids").cast("bigint").alias("n_pieces"),
        F.size(F.filter("ids", lambda i: i.between(low, high))).cast("bigint").alias("n_bytes"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
        (F.col("decoded") == F.translate(F.coalesce("text", F.lit("")), unigram.MARK, " ")).alias("round_trip"))


def op11_exactdedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents whose texts are equal but for the case of A-Z; the largest doc_id stays."""
    rows = exactdedup.deduplicate(spark, f"{sf_dir.rstrip('/')}/documents.parquet")
    return rows.select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Merkle manifest of all documents, and what a check finds after a fifth of the texts went to lower case."""
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    rows = manifest.manifest(_table(spark, sf_dir, "documents"), ["doc_id", "source", "lang", "n_chars", "text"], group="source",
                             order="doc_id", altered={"text": manifest.lower_ascii(F.col("text"))}, alter=tampered)
    found = rows.withColumn("folded_root", manifest.folded(F.col("altered"), F.col("path")))
    return found.select("doc_id", "leaf", "subroot", "root", manifest.proof_hash(F.col("path")).alias("proof_sha256"),
                        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def op13_filteraudit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove from each language's documents, in every order."""
    return filteraudit.audit_documents(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_toxicity": op1_toxicity,
    "op2_simhash": op2_simhash,
    "op3_chat": op3_chat,
    "op4_forest": op4_forest,
    "op5_langid": op5_langid,
    "op6_packing": op6_packing,
    "op7_topk": op7_topk,
    "op8_quality": op8_quality,
    "op9_linededup": op9_linededup,
    "op10_unigram": op10_unigram,
    "op11_exactdedup": op11_exactdedup,
    "op12_manifest": op12_manifest,
    "op13_filteraudit": op13_filteraudit,
}

_LOWER_ASCII = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _manifest_sql(levels: int = 6) -> str:
    """The manifest level by level, for groups of up to 16^levels rows and as many groups."""
    field = lambda c: f"coalesce(strlen({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')"
    leaf = lambda text: "sha256(" + " || ".join(map(field, ("doc_id", "source", "lang", "n_chars", text))) + ")"
    # crc32 bit by bit over the digits of the id
    crc = ("xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT), lambda c, b: "
           "list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda s, z: xor(s >> 1, 3988292384 * (s & 1)))), 4294967295)")
    ctes = [
        f"d AS (SELECT doc_id, source, {leaf('text')} AS h, CASE WHEN {crc} % 5 = 0 THEN {leaf(_LOWER_ASCII.format('text'))} ELSE {leaf('text')} END AS altered FROM documents)",
        "t0 AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id, h) - 1 AS i, count(*) OVER (PARTITION BY source) AS n FROM d)"]

    def climb(t):
        for k in range(levels):
            ctes.append(f"{t}{k + 1} AS (SELECT source, i // 16 AS i, (n + 15) // 16 AS n, sha256(string_agg(h, '' ORDER BY i)) AS h "
                        f"FROM {t}{k} WHERE n > 1 GROUP BY source, i // 16, (n + 15) // 16)")
        for k in range(levels):
            ctes.append(f"{t}x{k} AS (SELECT a.source, a.i, coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i < a.i), '') AS l, "
                        f"coalesce(string_agg(b.h, '' ORDER BY b.i) FILTER (b.i > a.i), '') AS r FROM {t}{k} AS a JOIN {t}{k} AS b "
                        f"ON a.source IS NOT DISTINCT FROM b.source AND a.i // 16 = b.i // 16 WHERE a.n > 1 GROUP BY a.source, a.i)")
        ctes.append(f"{t}r AS (" + " UNION ALL ".join(f"SELECT source, h FROM {t}{k} WHERE n = 1" for k in range(levels + 1)) + ")")

    climb("t")
    ctes.append("s0 AS (SELECT NULL::VARCHAR AS source, source AS key, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM tr)")
    climb("s")
    joins, proof, last = "", [], "t0.altered"
    for t, base in (("t", "t0"), ("s", "s0")):
        for k in range(levels):
            x = f"{t}x{k}"
            joins += f" LEFT JOIN {x} ON {x}.source IS NOT DISTINCT FROM {base}.source AND {x}.i = {base}.i // {16 ** k}"
            proof.append(f"coalesce({x}.l || {x}.r, '')")
    steps, last = [], "f0"
    for k, x in enumerate(f"{t}x{k}" for t in "ts" for k in range(levels)):
        steps.append(f"f{k + 1} AS (SELECT * EXCLUDE cur, CASE WHEN {x}_l IS NULL THEN cur ELSE sha256({x}_l || cur || {x}_r) END AS cur FROM f{k})")
        last = f"f{k + 1}"
    sides = ", ".join(f"{t}x{k}.{c} AS {t}x{k}_{c}" for t in "ts" for k in range(levels) for c in "lr")
    ctes.append(f"f0 AS (SELECT t0.doc_id, t0.h AS leaf, tr.h AS subroot, sr.h AS root, sha256({' || '.join(proof)}) AS proof_sha256, t0.altered AS cur, {sides} "
                f"FROM t0 JOIN tr ON tr.source IS NOT DISTINCT FROM t0.source JOIN s0 ON s0.key IS NOT DISTINCT FROM t0.source CROSS JOIN sr{joins})")
    return "WITH " + ", ".join(ctes + steps) + f" SELECT doc_id, leaf, subroot, root, proof_sha256, cur AS folded_root, cur = root AS verified FROM {last}"


#: DuckDB SQL by query, where SQL can express the result.
ORACLE: dict[str, str] = {
    # Text lengths follow the template: 8 + 8 marks and 8 at the end of a turn,
    # and one more character for each escaped control string.
    "op3_chat": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
            UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'),
        u AS (
            SELECT *, 24 + length(role) + length(text)
                + len(regexp_extract_all(role || chr(0) || text, '[<\[]\\*(\||s>|/s>|INST\]|/INST\])')) AS chars FROM t)
        SELECT conv_id, count(*) AS n_turns,
            sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
            sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END)::BIGINT AS loss_chars,
            sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(chars)::BIGINT AS formatted_chars
        FROM u GROUP BY conv_id""",
    "op7_topk": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS z FROM embeddings
            WHERE embedding IS NOT NULL AND len(embedding) > 0 AND vec_id IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        p AS (
            SELECT q.vec_id AS query_id, v.vec_id, list_inner_product(q.z, v.z)::BIGINT AS score
            FROM v AS q JOIN v ON q.vec_id <> v.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM p)
        SELECT * FROM r WHERE rank <= 5""",
    "op11_exactdedup": f"""
        WITH t AS (SELECT doc_id, {_LOWER_ASCII.format("coalesce(text, '')")} AS t FROM documents)
        SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
            row_number() OVER (PARTITION BY t ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(t) AS text_sha256
        FROM t WINDOW w AS (PARTITION BY t)""",
    "op12_manifest": _manifest_sql(),
    # every order step by step; shapley is the plain sum over the orders
    "op13_filteraudit": r"""
        WITH w AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
                regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
        l AS (SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id),
        f AS (
            SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
                (CASE WHEN len(ws) < 100 THEN 'A' ELSE '' END)
                || (CASE WHEN 100 * len(list_distinct(ws)) < 80 * len(ws) THEN 'B' ELSE '' END)
                || (CASE WHEN 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t) THEN 'C' ELSE '' END)
                || (CASE WHEN regexp_matches(t, '[#$%&*|]') THEN 'D' ELSE '' END)
                || (CASE WHEN w.doc_id > min(w.doc_id) OVER (PARTITION BY t) THEN 'E' ELSE '' END) AS failed
            FROM w LEFT JOIN l ON l.doc_id = w.doc_id),
        h AS (SELECT part, failed, count(*) AS n, count(*) FILTER (good) AS g, count(*) FILTER (toxic) AS x FROM f GROUP BY ALL),
        c AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS c),
        o AS (
            SELECT a.c || b.c || d.c || e.c || g.c AS filter_order FROM c a, c b, c d, c e, c g
            WHERE len(list_distinct([a.c, b.c, d.c, e.c, g.c])) = 5),
        s AS (
            SELECT filter_order, k::INTEGER AS step, filter_order[k] AS filter, '[' || filter_order[:k - 1] || '#]' AS before
            FROM o, range(1, 6) AS r(k)),
        m AS (
            SELECT part, filter_order, step, filter,
                sum(n) FILTER (NOT regexp_matches(failed, before) AND NOT contains(failed, filter)) AS kept,
                sum(n) FILTER (NOT regexp_matches(failed, before) AND contains(failed, filter)) AS removed,
                sum(n) FILTER (regexp_matches(failed, before) AND contains(failed, filter)) AS redundant,
                sum(n) FILTER (failed = filter) AS unique_fails,
                sum(g) FILTER (NOT regexp_matches(failed, before) AND contains(failed, filter)) AS good_lost,
                sum(x) FILTER (NOT regexp_matches(failed, before) AND contains(failed, filter)) AS toxic_lost
            FROM s, h GROUP BY ALL)
        SELECT part, filter_order, step, filter, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
            coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
            coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
            coalesce(sum(removed) OVER (PARTITION BY part, filter), 0)::BIGINT AS shapley
        FROM m""",
}
