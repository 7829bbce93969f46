"""One query for each operator, over whole tables with production parameters, and SQL where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import bpe, chat, jaccard_join, language, line_join, packing, quality, spelling, top_k, toxicity, turn_trie, unit_dedup, url_graph
from .url_graph import Rule

VOCABULARY = "byte_bpe_50k.json"


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op5_byte_bpe(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers  # only this query needs it

    vocabulary = public_tokenizers.path(VOCABULARY)
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    return bpe.round_trip_digests(documents, vocabulary, pattern=public_tokenizers.PATTERN)


def op10_exact_top_k(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return top_k.exact_top_k(vectors, vectors.where("vec_id % 50 = 0"), k=5)


OP10_SQL = """
    WITH v AS (SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS e FROM embeddings
               WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
               AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
    s AS (SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e)::BIGINT AS score
          FROM v q JOIN v c ON q.vec_id <> c.vec_id AND len(q.e) = len(c.e) WHERE q.vec_id % 50 = 0),
    r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
    SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5"""


URL_RULES = [Rule("block", "net", "/"), Rule("allow", "example.net", "/en/"), Rule("block", "example.com", "/de/"), Rule("allow", "org", "/fr/")]
DAMPING, ROUNDS, THRESHOLD = 0.85, 20, 0.5


def op9_url_graph(spark: SparkSession, folder: str) -> DataFrame:
    return url_graph.judge_urls(_table(spark, folder, "pages"), URL_RULES, damping=DAMPING, rounds=ROUNDS, threshold=THRESHOLD)


def _op9_sql() -> str:
    fits = lambda r: f"(host = '{r.host}' OR ends_with(host, '.{r.host}')) AND starts_with(path, '{r.path}')"
    longest = sorted(URL_RULES, key=lambda r: -len(r.host + r.path))
    case = lambda what: "CASE " + " ".join(f"WHEN {fits(r)} THEN '{what(r)}'" for r in longest) + " END"
    lower = lambda x: f"translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    link = url_graph.LINK.replace("'", "''")
    one, rest, big = url_graph.ONE, 1 - DAMPING, "::BIGINT"
    steps = [f"""
        r0 AS (SELECT host, floor({rest!r} * trust){big} AS trust, floor({rest!r} * distrust){big} AS distrust FROM seeds)"""]
    for i in range(1, ROUNDS + 1):
        steps.append(f"""
        r{i} AS MATERIALIZED (SELECT host, sum(trust){big} AS trust, sum(distrust){big} AS distrust FROM (SELECT * FROM r0
          UNION ALL SELECT dst, floor({DAMPING!r} * trust * links / of_src){big}, 0 FROM edges JOIN r{i - 1} ON src = host
          UNION ALL SELECT src, 0, floor({DAMPING!r} * distrust * links / of_dst){big} FROM edges JOIN r{i - 1} ON dst = host) GROUP BY host)""")
    return f"""
    WITH rest AS (SELECT page_id, html, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS x FROM pages),
    split AS (SELECT page_id, html, {lower("regexp_extract(x, '^[^/?#]*')")} AS host, regexp_extract(x, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
    ruled AS (SELECT page_id, html, host, path, {case(lambda r: r.host + r.path)} AS rule, {case(lambda r: r.verdict)} AS ruled FROM split),
    links AS (SELECT host AS src, {lower(f"unnest(regexp_extract_all(html, '{link}', 1))")} AS dst FROM ruled WHERE host <> ''),
    pairs AS (SELECT src, dst, count(*) AS links FROM links WHERE src <> dst GROUP BY ALL),
    edges AS MATERIALIZED (SELECT *, sum(links) OVER (PARTITION BY src)::DOUBLE AS of_src, sum(links) OVER (PARTITION BY dst)::DOUBLE AS of_dst FROM pairs),
    seeds AS (SELECT host, floor({one}::DOUBLE * (count(*) FILTER (ruled = 'allow'))::DOUBLE / count(*)) AS trust,
                     floor({one}::DOUBLE * (count(*) FILTER (ruled = 'block'))::DOUBLE / count(*)) AS distrust FROM ruled WHERE host <> '' GROUP BY host),
    {",".join(steps)}
    SELECT page_id, host, path, rule, coalesce(trust, 0) AS trust, coalesce(distrust, 0) AS distrust,
           coalesce(ruled, CASE WHEN distrust - trust >= {int(THRESHOLD * rest * one)} THEN 'block' ELSE 'allow' END) AS verdict
    FROM ruled LEFT JOIN r{ROUNDS} USING (host)"""


def op1_robust_outliers(spark: SparkSession, folder: str) -> DataFrame:
    return quality.quality_rules(_table(spark, folder, "documents"))


def _cleaned(documents: DataFrame) -> DataFrame:
    """What a removal of lines did to each document: counts, the spans kept, and the new text's digest."""
    spans = F.array_join(F.transform("kept", lambda s: F.concat_ws("-", s["start"].cast("string"), s["end"].cast("string"))), ",")
    return documents.select("doc_id", "n_units", "n_removed", F.coalesce(spans, F.lit("")).alias("kept"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))


def op2_line_join(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(line_join.remove_near_repeats(_table(spark, folder, "documents").select("doc_id", "text")))


def op3_perspectives(spark: SparkSession, folder: str) -> DataFrame:
    views = chat.rotate_perspectives(_table(spark, folder, "conversations"))
    return views.withColumn("mask", chat.mask_text(F.col("mask")))


OP3_SQL = """
    WITH t AS (SELECT conv_id, coalesce(turn, 9223372036854775807) AS turn,
                      translate(replace(coalesce(role, 'unknown'), '<|', '< |'), chr(10), ' ') AS who,
                      replace(coalesce(text, ''), '<|', '< |') AS text FROM conversations),
    n AS (SELECT *, turn // 1024 AS part, row_number() OVER (PARTITION BY conv_id ORDER BY turn, who, text) AS i FROM t),
    v AS (SELECT DISTINCT conv_id, who AS speaker FROM t WHERE who <> 'system'),
    p AS (SELECT n.conv_id, speaker, part, i, who = speaker AS own, text, '<|im_start|>' || CASE WHEN who = speaker THEN 'assistant'
                 WHEN who = 'system' THEN 'system' ELSE 'user name=' || who END || chr(10) AS head
          FROM n JOIN v ON n.conv_id IS NOT DISTINCT FROM v.conv_id),
    q AS (SELECT *, head || text || '<|im_end|>' || chr(10) AS piece FROM p),
    s AS (SELECT *, (sum(length(piece)) OVER (PARTITION BY conv_id, speaker, part ORDER BY i))::BIGINT AS stop FROM q)
    SELECT conv_id, speaker, part, count(*) AS n_turns, string_agg(piece, '' ORDER BY i) AS text,
           coalesce(string_agg(CASE WHEN own THEN (stop - length(piece) + length(head)) || '-' || stop END, ',' ORDER BY i), '') AS mask
    FROM s GROUP BY conv_id, speaker, part"""

def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_join.jaccard_components(_table(spark, folder, "documents"))


OP7_SQL = r"""
    WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
    u AS (SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
                 WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s FROM w),
    s AS MATERIALIZED (SELECT DISTINCT doc_id, hash(s) AS s FROM u),
    n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
    p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
    l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)),
    r AS (SELECT doc_id AS id, doc_id AS at FROM documents UNION SELECT id, b FROM r JOIN l ON l.a = r.at)
    SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, min(r.at) AS component_id
    FROM documents d LEFT JOIN n USING (doc_id) JOIN r ON r.id = d.doc_id GROUP BY d.doc_id, n.n"""

def op4_best_fit(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(_table(spark, folder, "documents"))


def op6_line_hashing(spark: SparkSession, folder: str) -> DataFrame:
    return _cleaned(unit_dedup.remove_repeated_units(_table(spark, folder, "documents").select("doc_id", "text")))


#: Lines with their number i, words joined by spaces (unit), and whether they have a word (counts); {gone} decides.
_LINES = r"""
    d AS (SELECT doc_id, text, string_split(text, chr(10)) AS parts FROM documents),
    u AS (SELECT doc_id, unnest(parts) AS part, generate_subscripts(parts, 1) AS i, len(parts) AS n FROM d),
    v AS (SELECT doc_id, i, part || CASE WHEN i < n THEN chr(10) ELSE '' END AS piece,
          trim(regexp_replace(translate(part, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x09-\x0D\x20-\x2F\x3A-\x40\x5B-\x60\x7B-\x7E]+', ' ', 'g'), ' ') AS unit
          FROM u WHERE i < n OR part <> '' OR n = 1),
    w AS MATERIALIZED (SELECT *, len(unit) > 0 AS counts FROM v)"""
_WITHOUT = """
    y AS (SELECT *, i - row_number() OVER (PARTITION BY doc_id, gone ORDER BY i) AS run,
          (sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY i))::BIGINT AS stop FROM x),
    z AS (SELECT doc_id, run, min(stop - length(piece)) AS a, max(stop) AS b FROM y WHERE NOT gone AND piece <> '' GROUP BY ALL),
    s AS (SELECT doc_id, string_agg(a || '-' || b, ',' ORDER BY a) AS kept FROM z GROUP BY ALL),
    t AS (SELECT doc_id, count(*) AS n_units, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(CASE WHEN NOT gone THEN piece END, '' ORDER BY i), '') AS body FROM x GROUP BY ALL)
    SELECT doc_id, coalesce(n_units, 0) AS n_units, coalesce(n_removed, 0) AS n_removed, coalesce(kept, '') AS kept, sha256(coalesce(body, '')) AS text_sha256
    FROM documents LEFT JOIN t USING (doc_id) LEFT JOIN s USING (doc_id)"""
OP6_SQL = f"""WITH {_LINES},
    x AS (SELECT *, counts AND row_number() OVER (PARTITION BY counts, unit ORDER BY doc_id, i) > 1 AS gone FROM w), {_WITHOUT}"""
#: Sets of words; lines of equal sets collapse; tokens by rarity; candidates share one of the first; then the whole sets.
OP2_SQL = f"""WITH {_LINES},
    e AS (SELECT doc_id, i, list_sort(list_distinct(string_split(unit, ' '))) AS k FROM w WHERE counts),
    f AS MATERIALIZED (SELECT k, len(k) AS n, min((doc_id, i)) AS first, row_number() OVER () AS c FROM e GROUP BY k),
    g AS (SELECT c, n, unnest(k) AS token FROM f),
    h AS (SELECT *, count(*) OVER (PARTITION BY token) AS df FROM g),
    p AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY c ORDER BY df, token) AS place FROM h)
          WHERE place <= n - ceil(0.8 * n) + 1 AND df > 1),
    q AS (SELECT DISTINCT a.c AS a, b.c AS b FROM p a JOIN p b ON a.token = b.token AND a.c < b.c AND a.n <= 1.25 * b.n AND b.n <= 1.25 * a.n),
    r AS (SELECT x.first AS fx, y.first AS fy, x.k AS kx, y.k AS ky, len(list_intersect(x.k, y.k)) AS m, x.n + y.n AS total
          FROM q JOIN f x ON x.c = q.a JOIN f y ON y.c = q.b),
    l AS (SELECT DISTINCT CASE WHEN fx > fy THEN fx ELSE fy END AS late FROM r WHERE 100 * m >= 80 * (total - m)),
    x AS (SELECT w.*, e.k IS NOT NULL AND ((w.doc_id, w.i) <> f.first OR (w.doc_id, w.i) IN (SELECT late FROM l)) AS gone
          FROM w LEFT JOIN e USING (doc_id, i) LEFT JOIN f USING (k)), {_WITHOUT}"""


#: Low quality comes first: what is junk tells something about what is toxic.
CATEGORIES = {"low_quality": "quality = 0", "toxic": "toxic = 1"}


def op8_classifier_chain(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text")
    scored = toxicity.score(documents, toxicity.fit_chain(documents, _table(spark, folder, "labels"), CATEGORIES)).drop("text")
    toxic = F.col("p_toxic") >= 0.5
    return scored.select("doc_id", F.round("p_low_quality", 6).alias("p_low_quality"), F.round("p_toxic", 6).alias("p_toxic"), toxic.alias("toxic"), (~toxic).alias("kept"))


#: The CRC-32 table as a list, and the CRC-32 of a text by it.
_CRC_TABLE = """list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)),
                lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))"""


def _crc(text: str, table: str) -> str:
    octets = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: xor(c >> 8, {table}[(xor(c, b) & 255) + 1])), 4294967295::BIGINT)"


def op11_turn_trie(spark: SparkSession, folder: str) -> DataFrame:
    conversations = _table(spark, folder, "conversations")
    return turn_trie.prefix_trie(turn_trie.shared_openings(turn_trie.turns_of(conversations)), conversations)


#: Every beginning of every conversation, then what each shares with those it begins.
OP11_SQL = f"""
    WITH t AS (SELECT {_CRC_TABLE} AS crcs),
    o AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                 row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), md5(coalesce(text, ''))) AS i
          FROM conversations WHERE conv_id IS NOT NULL),
    c AS (SELECT conv_id, {_crc("conv_id::VARCHAR", "crcs")} % 4 AS h FROM (SELECT DISTINCT conv_id FROM o), t),
    r AS (SELECT c.conv_id, i, 0 AS own, role, text FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % 20 AND i <= h
          UNION ALL SELECT c.conv_id, i, 1, role, text FROM c JOIN o ON o.conv_id = c.conv_id AND i > h),
    s AS (SELECT c.conv_id, coalesce(list(struct_pack(role := role, text := text) ORDER BY own, i) FILTER (role IS NOT NULL), []) AS turns
          FROM c LEFT JOIN r USING (conv_id) GROUP BY c.conv_id),
    p AS MATERIALIZED (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS depth FROM s),
    n AS MATERIALIZED (SELECT turns[:depth] AS k, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
                       coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len(turns)), '') AS ended FROM p GROUP BY ALL),
    m AS MATERIALIZED (SELECT n.*, u.conv_id AS parent_conv_id, (n_convs - 1) * CASE WHEN depth > 0 THEN len(regexp_extract_all(k[-1].text, '[^\x20\x09-\x0D]+')) ELSE 0 END AS saved,
                       coalesce(g.n, 0) AS n_children
          FROM n LEFT JOIN (SELECT k[:-2] AS k, count(*) AS n FROM n WHERE depth > 0 GROUP BY ALL) g USING (k)
          LEFT JOIN (SELECT k, conv_id FROM n) u ON n.depth > 0 AND u.k = n.k[:-2]),
    a AS (SELECT k[:d] AS k, sum(saved)::BIGINT AS saved_tokens, count(*) FILTER (n_children = 0) AS n_leaves
          FROM (SELECT *, unnest(range(depth + 1)) AS d FROM m) GROUP BY ALL)
    SELECT conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, sha256(ended) AS ends_sha256 FROM m JOIN a USING (k)"""

def op12_language_kernels(spark: SparkSession, folder: str) -> DataFrame:
    documents = _table(spark, folder, "documents").select("doc_id", "text", "lang")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = language.fit_languages(documents, ~held_out)
    found = language.identify(documents.select("doc_id", "text"), model)
    return found.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "lang_pred", F.round("score", 6).alias("score"))


#: Every so many run would be spelled wrong.
TYPO_EVERY = 97


def op13_spelling_variants(spark: SparkSession, folder: str) -> DataFrame:
    return spelling.spelling_variants(_table(spark, folder, "documents"), TYPO_EVERY)


#: Words as strings without one code point: two of a size that agree without the same one, or one that is the other without one.
OP13_SQL = f"""
    WITH RECURSIVE t AS (SELECT {_CRC_TABLE} AS crcs),
    runs AS (SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[a-z\u00C0-\u00FF]+')) AS run FROM documents),
    d AS (SELECT id || ':' || run AS named, run, count(*) AS n FROM runs GROUP BY ALL),
    h AS (SELECT run, n, {_crc("named", "crcs")} AS h FROM d, t),
    w AS (SELECT CASE WHEN h % {TYPO_EVERY} = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM h),
    v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM w WHERE length(word) >= 5 GROUP BY word HAVING sum(n) >= 3),
    i AS (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v),
    l AS MATERIALIZED (SELECT word, n, i, left(word, i - 1) || substr(word, i + 1) AS rest FROM i),
    p AS (SELECT a.word, b.word AS near, b.n AS near_n FROM l a JOIN l b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
          UNION SELECT l.word, v.word, v.n FROM l JOIN v ON l.rest = v.word UNION SELECT v.word, l.word, l.n FROM l JOIN v ON l.rest = v.word),
    b AS (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS place, count(*) OVER (PARTITION BY word) AS n_near FROM p),
    f AS MATERIALIZED (SELECT v.word, v.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 2 * n THEN near END AS form,
                       CASE WHEN near_n >= 2 * n THEN near_n END AS form_n FROM v LEFT JOIN b ON b.word = v.word AND place = 1),
    r AS (SELECT word, word AS root, form AS next FROM f UNION ALL SELECT r.word, f.word, f.form FROM r JOIN f ON f.word = r.next)
    SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM f JOIN r ON r.word = f.word AND r.next IS NULL"""


QUERIES = {f.__name__: f for f in (op1_robust_outliers, op2_line_join, op3_perspectives, op4_best_fit, op5_byte_bpe, op6_line_hashing, op7_jaccard_join, op8_classifier_chain, op9_url_graph, op10_exact_top_k, op11_turn_trie, op12_language_kernels, op13_spelling_variants)}
SQL = {"op2_line_join": OP2_SQL, "op3_perspectives": OP3_SQL, "op6_line_hashing": OP6_SQL, "op7_jaccard_join": OP7_SQL, "op9_url_graph": _op9_sql(), "op10_exact_top_k": OP10_SQL, "op11_turn_trie": OP11_SQL, "op13_spelling_variants": OP13_SQL}
