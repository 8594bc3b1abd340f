"""The queries of the operators, opN_<name>, and SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read


def op1_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .suffix_dedup import remove_repeats

    out = remove_repeats(read(spark, sf_dir, "documents"))
    left = F.make_valid_utf8(F.col("kept").cast("string"))  # U+FFFD for what a cut leaves of a character
    return out.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"), left.alias("text"))


def op2_segment_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .segment_sampling import sample

    out = sample(read(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"), decoded=True)
    return out.select("doc_id", "rank", "log_prob", "perturbed", "log_inclusion", F.size("ids").alias("n_pieces"), F.xxhash64("ids").alias("ids_hash"), F.sha2("text", 256).alias("decoded_sha256"))


RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import judge

    return judge(read(spark, sf_dir, "pages"), RULES)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import warc

    folder = warc.new_folder(spark)
    warc.write(read(spark, sf_dir, "pages"), folder)
    captures = warc.assemble(warc.read(spark, folder, with_payload=False))
    from .common import cut

    captures = cut(captures.select("capture_id", "response", F.regexp_extract("metadata.fields", r"page-id: (-?\d+)", 1).try_cast("long").alias("page_id")))  # the archives are read once
    firsts = captures.filter("response.kind = 'response'").select(F.col("capture_id").alias("first_id"), F.col("page_id").alias("first_page"), F.col("response.payload_bytes").alias("first_bytes"))
    again = captures.filter("response.kind = 'revisit'").join(firsts, F.col("response.refers_to") == F.col("first_id"))
    row = lambda df, size, refers: df.select("page_id", size.alias("payload_bytes"), F.col("response.payload_digest").alias("payload_digest"), F.col("response.kind").alias("record_type"), refers.alias("refers_to"), F.col("response.target_uri").alias("target_uri"))
    return row(captures.filter("response.kind = 'response'"), F.col("response.payload_bytes"), F.lit(None).cast("long")).union(row(again, F.col("first_bytes"), F.col("first_page")))


def op5_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .minhash import near_duplicates

    return near_duplicates(read(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id", "kept")


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from .packing import pack

    out = pack(read(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens", "step_group")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup

    return exact_dedup(read(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op8_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .quotes import link_quotations

    out = link_quotations(read(spark, sf_dir, "conversations"))
    shown = lambda x: F.coalesce(x.cast("string"), F.lit("-"))
    links = F.array_join(F.transform("quotes", lambda q: F.concat_ws(":", q.level.cast("string"), F.md5(q.passage), shown(q.conv_id), shown(q.turn))), " ")
    return out.select("conv_id", "turn", "role", "body", F.size("quotes").cast("long").alias("n_quotes"), links.alias("links"), "parent_turn", "root_turn", "place", "depth")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .fingerprint import neighbours

    out = neighbours(read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import toxicity

    docs = read(spark, sf_dir, "documents")
    out = toxicity.score(docs, toxicity.fit(docs, read(spark, sf_dir, "labels")))
    return out.select("doc_id", toxicity.held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"), "matched", "n_words")


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .filter_audit import audit

    return audit(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op12_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import quality
    from .common import table

    rows = table(quality.ledger(read(spark, sf_dir, "documents").select("doc_id", "text")))  # the ledger is stored; policies read it
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", quality.rejected(quality.BASE).alias("base_failed"), (~quality.rejected()).alias("kept"), "fail_bits")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .hard_negatives import mine

    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(read(spark, sf_dir, "embeddings"), label, F.col("vec_id") % 100 == 0)


NORMAL = r"lower(trim(regexp_replace(x, '\s+', ' ', 'g')))"
OP8_SQL = rf"""
    WITH RECURSIVE m AS (SELECT row_number() OVER () AS uid, conv_id, turn, role, coalesce(text, '') AS t FROM conversations),
    l AS (SELECT uid, unnest(string_split(t, chr(10))) AS line, generate_subscripts(string_split(t, chr(10)), 1) AS pos FROM m WHERE regexp_matches(t, '(?m)^[ \t]*>')),
    v AS (SELECT uid, pos, length(regexp_replace(regexp_extract(line, '^(?:[ \t]*>)+'), '[^>]', '', 'g')) AS level, regexp_replace(line, '^(?:[ \t]*>)+[ \t]?', '') AS line FROM l),
    w AS (SELECT *, coalesce((lag(level) OVER q <> level)::INT, 1) AS new, coalesce(lead(level) OVER q, 0) AS nxt FROM v WINDOW q AS (PARTITION BY uid ORDER BY pos)),
    r AS (SELECT * FROM (SELECT *, sum(new) OVER (PARTITION BY uid ORDER BY pos) AS run FROM w) WHERE NOT (level = 0 AND nxt > 0 AND regexp_matches(line, '(?i)^[ \t]*on\b.+\bwrote:[ \t\r]*$'))),
    b AS (SELECT uid, trim(string_agg(line, chr(10) ORDER BY pos)) AS body FROM r WHERE level = 0 GROUP BY uid),
    msg AS (SELECT m.uid, conv_id, turn, role, CASE WHEN regexp_matches(t, '(?m)^[ \t]*>') THEN coalesce(body, '') ELSE t END AS body FROM m LEFT JOIN b USING (uid)),
    p AS (SELECT * FROM (SELECT uid, run, level, string_agg(line, chr(10) ORDER BY pos) AS passage FROM r WHERE level > 0 GROUP BY ALL) JOIN (SELECT uid, conv_id, turn FROM m) USING (uid) WHERE trim(passage) <> ''),
    orig AS (SELECT DISTINCT conv_id, turn, {NORMAL} AS norm FROM (SELECT conv_id, turn, unnest(list_concat([body], string_split_regex(body, '\n[ \t\r]*\n'), string_split(body, chr(10)))) AS x FROM msg WHERE conv_id IS NOT NULL AND turn IS NOT NULL)),
    parts AS (SELECT uid, run, conv_id, turn, 3 AS size, passage AS x FROM p UNION ALL SELECT uid, run, conv_id, turn, 2, unnest(string_split_regex(passage, '\n[ \t\r]*\n')) FROM p UNION ALL SELECT uid, run, conv_id, turn, 1, unnest(string_split(passage, chr(10))) FROM p),
    asked AS (SELECT * FROM (SELECT DISTINCT uid, run, conv_id, turn, size, {NORMAL} AS norm FROM parts) WHERE norm <> ''),
    near AS (SELECT a.uid, a.run, a.size, 1 AS own, a.conv_id AS c, min(o.turn) AS to_turn FROM asked a JOIN orig o USING (conv_id, norm) GROUP BY a.uid, a.run, a.size, a.conv_id, a.turn, a.norm HAVING min(o.turn) < a.turn),
    others AS (SELECT a.uid, a.run, a.size, min(struct_pack(c := o.conv_id, t := o.turn)) AS f FROM asked a JOIN orig o USING (norm) WHERE o.conv_id IS DISTINCT FROM a.conv_id GROUP BY a.uid, a.run, a.size, a.norm),
    far AS (SELECT uid, run, size, 0 AS own, f.c AS c, f.t AS to_turn FROM others),
    best AS (SELECT * FROM (FROM near UNION ALL FROM far) QUALIFY row_number() OVER (PARTITION BY uid, run ORDER BY own DESC, size DESC, c, to_turn) = 1),
    inner_links AS (SELECT p.uid, p.conv_id, p.turn, p.level, to_turn FROM p JOIN best USING (uid, run) WHERE best.c IS NOT DISTINCT FROM p.conv_id),
    parent AS (SELECT uid, conv_id, turn, max(to_turn) AS parent_turn FROM inner_links i WHERE level = (SELECT min(level) FROM inner_links j WHERE j.uid = i.uid) GROUP BY ALL),
    par AS (SELECT conv_id, turn, max(parent_turn) AS above FROM parent GROUP BY ALL),
    rec AS (SELECT conv_id, turn, above, [turn] AS path FROM par UNION ALL SELECT rec.conv_id, rec.turn, par.above, [rec.above] || path FROM rec JOIN par ON par.conv_id = rec.conv_id AND par.turn = rec.above),
    replied AS (SELECT conv_id, turn, [above] || path AS path FROM rec WHERE NOT EXISTS (FROM par WHERE par.conv_id = rec.conv_id AND par.turn = rec.above)),
    paths AS (FROM replied UNION SELECT conv_id, path[1], [path[1]] FROM replied),
    places AS (SELECT conv_id, turn, path[1] AS root, len(path) - 1 AS depth, row_number() OVER (PARTITION BY conv_id, path[1] ORDER BY path) - 1 AS place FROM paths),
    quoted AS (SELECT uid, count(*) AS n, string_agg(level || ':' || md5(passage) || ':' || coalesce(c::VARCHAR, '-') || ':' || coalesce(to_turn::VARCHAR, '-'), ' ' ORDER BY run) AS links FROM p LEFT JOIN best USING (uid, run) GROUP BY uid)
    SELECT msg.conv_id, msg.turn, role, body, coalesce(n, 0) AS n_quotes, coalesce(links, '') AS links, parent_turn, CASE WHEN parent_turn IS NULL THEN msg.turn ELSE root END AS root_turn,
           CASE WHEN parent_turn IS NULL THEN 0 ELSE place END AS place, CASE WHEN parent_turn IS NULL THEN 0 ELSE depth END AS depth
    FROM msg LEFT JOIN quoted USING (uid) LEFT JOIN parent USING (uid) LEFT JOIN places ON places.conv_id = msg.conv_id AND places.turn = msg.turn"""


WORDS = r"[^\x20\x09-\x0D]+"
OP11_SQL = rf"""
    WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '{WORDS}') AS ws FROM d),
    f AS (SELECT uid, part, doc_id, len(ws) < 200 AS a, 100 * len(list_distinct(ws)) < 50 * len(ws) AS b, 100 * len(regexp_extract_all(t, '[A-Z]')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
          coalesce(min(doc_id) OVER (PARTITION BY t) < doc_id, false) AS e, doc_id IN (SELECT doc_id FROM labels WHERE quality = 1) AS good, doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1) AS toxic FROM w),
    failed AS (SELECT part, good, toxic, (CASE WHEN a THEN 'A' ELSE '' END) || (CASE WHEN b THEN 'B' ELSE '' END) || (CASE WHEN c THEN 'C' ELSE '' END) || (CASE WHEN d THEN 'D' ELSE '' END) || (CASE WHEN e THEN 'E' ELSE '' END) AS letters FROM f),
    l AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
    o AS (SELECT a.x || b.x || c.x || d.x || e.x AS filter_order FROM l a, l b, l c, l d, l e WHERE a.x NOT IN (b.x, c.x, d.x, e.x) AND b.x NOT IN (c.x, d.x, e.x) AND c.x NOT IN (d.x, e.x) AND d.x <> e.x),
    s AS (SELECT filter_order, i::INT AS step, filter_order[i] AS filter, substr(filter_order, 1, i - 1) AS before FROM o, unnest(range(1, 6)) AS t(i)),
    cells AS (SELECT part, letters, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic FROM failed GROUP BY ALL),
    r AS (SELECT *, before <> '' AND regexp_matches(letters, '[' || before || 'x]') AS gone, contains(letters, filter) AS fails FROM cells, s),
    t AS (SELECT part, filter_order, step, filter, coalesce(sum(n) FILTER (NOT gone AND NOT fails), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (NOT gone AND fails), 0)::BIGINT AS removed,
          coalesce(sum(n) FILTER (gone AND fails), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (letters = filter), 0)::BIGINT AS unique_fails,
          coalesce(sum(good) FILTER (NOT gone AND fails), 0)::BIGINT AS good_lost, coalesce(sum(toxic) FILTER (NOT gone AND fails), 0)::BIGINT AS toxic_lost FROM r GROUP BY ALL)
    SELECT *, (sum(removed) OVER (PARTITION BY part, filter))::BIGINT AS shapley FROM t"""
OP12_SQL = rf"""
    WITH d AS (SELECT row_number() OVER () AS uid, doc_id, coalesce(text, '') AS t FROM documents),
    w AS (SELECT *, regexp_extract_all(t, '{WORDS}') AS ws, list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{WORDS}')) AS ls FROM d),
    grams AS (SELECT uid, i, ws[i : i + 7] AS g FROM (SELECT uid, ws, unnest(range(1, len(ws) - 6)) AS i FROM w)),
    twice AS (SELECT uid, i FROM grams QUALIFY count(*) OVER (PARTITION BY uid, g) > 1),
    covered AS (SELECT uid, count(DISTINCT p) AS n FROM (SELECT uid, unnest(range(i, i + 8)) AS p FROM twice) GROUP BY uid),
    m AS (SELECT doc_id, len(ws) AS n_words, len(array_to_string(ws, '')) AS word_chars, length(regexp_replace(t, '[^#*$%&|<>]', '', 'g')) AS n_symbols, len(ls) AS n_lines, len(ls) - len(list_distinct(ls)) AS n_dup_lines,
          coalesce(n, 0) AS n_repeat_words, len(list_filter(ws, lambda x: regexp_matches(x, '\p{{L}}'))) AS n_alpha, length(regexp_replace(t, '\P{{Lu}}', '', 'g')) AS n_capitals, length(regexp_replace(t, '\P{{L}}', '', 'g')) AS n_letters
          FROM w LEFT JOIN covered USING (uid)),
    b AS (SELECT *, (n_words < 20)::BIGINT + 2 * (100 * n_repeat_words > 30 * n_words)::BIGINT + 4 * (word_chars < 3 * n_words OR word_chars > 10 * n_words)::BIGINT + 8 * (10 * n_symbols > n_words)::BIGINT
          + 16 * (100 * n_alpha < 80 * n_words)::BIGINT + 32 * (100 * n_dup_lines > 50 * n_lines)::BIGINT + 64 * (100 * n_capitals > 30 * word_chars)::BIGINT AS fail_bits FROM m)
    SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, fail_bits & 3 <> 0 AS base_failed, fail_bits = 0 AS kept, fail_bits FROM b"""


OP13_SQL = """
    WITH p AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
               WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, a.label = o.label AS same, list_inner_product(a.v, o.v)::BIGINT AS score FROM p a JOIN p o ON a.vec_id <> o.vec_id WHERE a.vec_id % 100 = 0),
    pos AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
    SELECT pos.anchor_id, pos.other_id AS positive_id, (row_number() OVER w)::INT AS rank, n.other_id AS negative_id, pos.score AS positive_score, n.score AS negative_score
    FROM pos JOIN s n ON n.anchor_id = pos.anchor_id AND NOT n.same AND 80 * pos.score <= 100 * n.score AND n.score <= pos.score
    WINDOW w AS (PARTITION BY pos.anchor_id, pos.other_id ORDER BY n.score DESC, n.other_id) QUALIFY row_number() OVER w <= 5"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name.startswith("op") and name[2:3].isdigit()}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": """
            WITH p AS (SELECT page_id, coalesce(html, '') AS h, regexp_replace(coalesce(url, ''), '[\r\n]', '', 'g') AS target_uri FROM pages),
            q AS (SELECT page_id, target_uri, octet_length(encode(h)) AS payload_bytes, sha256(h) AS payload_digest, min(page_id) OVER (PARTITION BY h) AS f FROM p)
            SELECT page_id, target_uri, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 100 AND f <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
                   CASE WHEN payload_bytes >= 100 AND f <> page_id THEN f END AS refers_to FROM q""",
        "op8_quotation_linking": OP8_SQL,
        "op11_filter_audit": OP11_SQL,
        "op12_quality_rules": OP12_SQL,
        "op13_hard_negatives": OP13_SQL,
        "op7_exact_dedup": """
            WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
            SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(t) AS text_sha256
            FROM d WINDOW w AS (PARTITION BY t)""",
    }
