"""The registered ``opN_*`` queries (whole tables, production parameters) and
their DuckDB formulations."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import ball_codes, bpe_pieces, ctw, exact_dedup, language_id, mixing, multi_index, prefix_trie, pseudonyms, simhash, suffix_dedup, token_orc, url_filter
from candlewick.llm.common import UPPER, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


def _rule_sql(column: str) -> str:
    """The longest rule that fits, as a CASE over rules by falling length."""
    at = 0 if column == "rule" else 1
    cases = []
    for r in sorted(url_filter.RULES, key=lambda r: (len(r[0]), r[0]), reverse=True):
        cut = r[0].index("/")
        host, path = r[0][:cut], r[0][cut:]
        cases.append(f"WHEN (host = '{host}' OR suffix(host, '.{host}')) AND prefix(path, '{path}') THEN '{r[at]}'")
    return f"CASE {' '.join(cases)} END AS {column}"


def _url_sql(order: int = url_filter.ORDER, folds: int = url_filter.FOLDS, grid: int = url_filter.GRID) -> str:
    levels, below = [], None
    for k in range(order + 1):
        ctx = f"right(ctx, {k})" if k else "''"
        low = "1.0 / count(*) OVER ()" if k == 0 else "b.p_{c}"
        join = "" if k == 0 else f" JOIN p{k - 1} b ON b.ctx = right(g.ctx, {k - 1}) AND b.ch = g.ch"
        if k == 1:
            join = " JOIN p0 b ON b.ch = g.ch"
        levels.append(f"g{k} AS (SELECT {ctx} AS ctx, ch, sum(n_allow) AS n_allow, sum(n_block) AS n_block FROM grams GROUP BY 1, 2)")
        cols = []
        for c in ("allow", "block"):
            n, t = f"sum(g.n_{c}) OVER (PARTITION BY g.ctx)", f"count(*) FILTER (g.n_{c} > 0) OVER (PARTITION BY g.ctx)"
            lo = low.format(c=c)
            cols.append(f"CASE WHEN {n} > 0 THEN (g.n_{c} + {t} * ({lo})) / ({n} + {t}) ELSE {lo} END AS p_{c}")
        levels.append(f"p{k} AS (SELECT g.ctx, g.ch, {', '.join(cols)} FROM g{k} g{join})")
    return f"""WITH a AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
b AS (SELECT page_id, url, rest, regexp_extract(rest, '^[^/?#]*') AS h FROM a),
c AS (SELECT page_id, url, translate(h, '{UPPER}', '{UPPER.lower()}') AS host,
      regexp_extract(substr(rest, length(h) + 1), '^[^?#]*') AS path FROM b),
d AS (SELECT *, {_rule_sql('rule')}, {_rule_sql('says')}, host || path AS s,
      CAST('0x' || substr(md5(url), 1, 8) AS BIGINT) % {folds} AS fold FROM c),
u AS (SELECT s, sum(CASE WHEN fold <> 0 AND says = 'allow' THEN 1 ELSE 0 END) AS w_allow,
      sum(CASE WHEN fold <> 0 AND says = 'block' THEN 1 ELSE 0 END) AS w_block FROM d GROUP BY s),
v AS (SELECT *, repeat(chr(2), {order}) || s || chr(3) AS padded FROM u),
w AS (SELECT s, w_allow, w_block, padded, unnest(range(1, length(padded) - {order} + 1)) AS i FROM v),
o AS (SELECT s, w_allow, w_block, substr(padded, i, {order}) AS ctx, substr(padded, i + {order}, 1) AS ch FROM w),
grams AS (SELECT ctx, ch, sum(w_allow) AS n_allow, sum(w_block) AS n_block FROM o GROUP BY 1, 2),
{', '.join(levels)},
sc AS (SELECT o.s, round(sum(ln(p.p_allow) - ln(p.p_block)) / count(*), 6) + 0.0 AS score FROM o JOIN p{order} p ON o.ctx = p.ctx AND o.ch = p.ch GROUP BY o.s),
e AS (SELECT d.*, CASE WHEN d.s = '' THEN 0.0 ELSE sc.score END AS score FROM d JOIN sc ON d.s = sc.s),
hist AS (SELECT floor(score * {grid}) AS b, count(*) FILTER (says = 'allow') AS a, count(*) FILTER (says = 'block') AS r
         FROM e WHERE fold = 0 AND says IS NOT NULL GROUP BY 1),
gain AS (SELECT b, (sum(a) OVER () - coalesce(sum(a) OVER under, 0)) / nullif(sum(a) OVER (), 0)
              + coalesce(sum(r) OVER under, 0) / nullif(sum(r) OVER (), 0) AS g, (coalesce(lag(b) OVER (ORDER BY b) + 1, b) + b) / 2 AS edge
         FROM hist WINDOW under AS (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
bar AS (SELECT coalesce((SELECT edge / {grid} FROM gain WHERE g IS NOT NULL ORDER BY g DESC, b LIMIT 1), 0.0) AS t)
SELECT page_id, host, path, rule, coalesce(says, CASE WHEN score >= (SELECT t FROM bar) THEN 'allow' ELSE 'block' END) AS verdict, score FROM e"""


@register("op1_url_filter", _url_sql())
def op1(spark, sf):
    return url_filter.judge_urls(table(spark, sf, "pages"))


#: crc32 of a decimal id: bytes are folded in one after the other, eight shifts each.
CRC32 = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(CAST({0} AS VARCHAR), ''), lambda ch: ord(ch)::BIGINT)),
 lambda a, b: list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295)"""


PSEUDONYM_KEY = "corpus-key-1"  # a secret in production: a parameter of the operator


@register("op2_pseudonyms")
def op2(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = pseudonyms.pseudonymise(docs, PSEUDONYM_KEY)
    return out.withColumnsRenamed({"_in0": "doc_id", "_in1": "text"})


@register("op3_simhash")
def op3(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@register("op4_context_tree")
def op4(spark, sf):
    return ctw.score_documents(table(spark, sf, "documents"))


RANK_SQL = rf"""WITH t AS (SELECT row_number() OVER () AS rid, doc_id, lower(text) AS text, lang,
      coalesce({CRC32.format("doc_id")}, 0) % 4 = 2 AS held_out FROM documents),
w AS (SELECT rid, ' ' || unnest(regexp_extract_all(text, '\p{{L}}+')) || ' ' AS word FROM t),
p AS (SELECT rid, word, unnest(range(1, length(word) + 1)) AS i FROM w),
g AS (SELECT rid, gram, count(*) AS n FROM (SELECT rid, substr(word, i, k) AS gram, i + k - 1 <= length(word) AS fits FROM p, (VALUES (1), (2), (3)) v(k))
      WHERE fits AND gram <> ' ' GROUP BY rid, gram),
d AS (SELECT rid, gram, row_number() OVER (PARTITION BY rid ORDER BY n DESC, length(gram), gram) - 1 AS r FROM g QUALIFY r < {language_id.TOP}),
l AS (SELECT lang, gram, row_number() OVER (PARTITION BY lang ORDER BY sum(n) DESC, length(gram), gram) - 1 AS r
      FROM g JOIN t USING (rid) WHERE NOT held_out AND lang IS NOT NULL GROUP BY lang, gram QUALIFY r < {language_id.TOP}),
x AS (SELECT d.rid, a.lang, sum(coalesce(abs(l.r - d.r), {language_id.TOP})) AS far, count(*) AS n
      FROM d CROSS JOIN (SELECT DISTINCT lang FROM l) a LEFT JOIN l ON l.lang = a.lang AND l.gram = d.gram GROUP BY d.rid, a.lang),
y AS (SELECT rid, lang, 1.0::DOUBLE - far::DOUBLE / ({language_id.TOP} * n) AS score FROM x QUALIFY row_number() OVER (PARTITION BY rid ORDER BY far, lang) = 1)
SELECT doc_id, held_out, coalesce(y.lang, 'und') AS lang_pred, coalesce(score, 0.0::DOUBLE) AS score FROM t LEFT JOIN y USING (rid)"""


@register("op5_language_id", RANK_SQL)
def op5(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    return language_id.identify(docs).select(F.col("_in0").alias("doc_id"), "held_out", "lang_pred", "score")


@register(
    "op6_exact_dedup",
    """WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size, doc_id = max(doc_id) OVER w AS kept, sha256(text) AS text_sha256
FROM t WINDOW w AS (PARTITION BY text)""",
)
def op6(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text")
    out = exact_dedup.mark_duplicates(docs)
    return out.select(F.col("_in0").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


@register("op7_token_orc")
def op7(spark, sf):
    path = token_orc.scratch_path(spark)
    token_orc.write_documents(table(spark, sf, "documents"), path)
    return token_orc.id_checksums(token_orc.read_documents(spark, path)).select("doc_id", "start", "n_tokens", "ids_crc32")


@register("op8_multi_index")
def op8(spark, sf):
    return multi_index.nearest_neighbours(table(spark, sf, "embeddings"))


MIX_CTES = r"""t AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
      CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h FROM documents),
s0 AS (SELECT source, sum(size) AS source_size FROM t GROUP BY source),
s1 AS (SELECT *, [5.0, 2.0, 1.0][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w, source_size * 2.0 AS cap,
       sum(source_size) OVER () * 1.5 AS budget FROM s0),
s2 AS (SELECT *, cap * sum(w) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
       <= w * (budget - coalesce(sum(cap) OVER (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS capped FROM s1),
s3 AS (SELECT source, source_size, CASE WHEN capped THEN cap ELSE (budget - sum(CASE WHEN capped THEN cap ELSE 0 END) OVER ()) * w
       / sum(CASE WHEN capped THEN 0 ELSE w END) OVER () END::DOUBLE AS target FROM s2),
c AS (SELECT t.*, s3.source_size, s3.target, sum(size) OVER (PARTITION BY t.source ORDER BY h) AS cum,
      sum(size) OVER (PARTITION BY t.source, h) AS tie
      FROM t JOIN s3 ON t.source IS NOT DISTINCT FROM s3.source),
x AS (SELECT *, least(target, source_size) AS b1, greatest(target - source_size, 0) AS b2 FROM c),
y AS (SELECT *, CASE WHEN b1 <= 0 THEN 0 WHEN b1 >= source_size THEN 1 WHEN cum < b1 THEN 1
                     WHEN cum - tie < b1 AND (b1 - (cum - tie)) * 2 >= tie THEN 1 ELSE 0 END
             + CASE WHEN b2 <= 0 THEN 0 WHEN b2 >= source_size THEN 1 WHEN cum < b2 THEN 1
                     WHEN cum - tie < b2 AND (b2 - (cum - tie)) * 2 >= tie THEN 1 ELSE 0 END AS copies FROM x)"""


@register(
    "op9_source_mix",
    f"WITH {MIX_CTES} SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, copies * size AS taken FROM y",
)
def op9(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    return mixing.mix(docs).select(F.col("_in0").alias("doc_id"), "size", "source_size", "target", "taken")


@register("op10_bpe_pieces")
def op10(spark, sf):
    return bpe_pieces.encode_documents(table(spark, sf, "documents"), ids=False)


def _ball_sql(parts: int = ball_codes.PARTS, entries: int = ball_codes.ENTRIES, rounds: int = ball_codes.ROUNDS) -> str:
    """Lloyd rounds with every part compared with every entry."""
    ctes = [
        f"""k AS MATERIALIZED (SELECT row_number() OVER () AS rid, vec_id, label, list_transform(embedding, lambda x: CAST(floor({ball_codes.SCALE} * CAST(x AS DOUBLE)) AS BIGINT)) AS v
 FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)""",
        f"p AS MATERIALIZED (SELECT rid, part, v[part * (len(v) // {parts}) + 1 : (part + 1) * (len(v) // {parts})] AS a FROM k, range({parts}) r(part))",
        f"""b0 AS MATERIALIZED (SELECT part, e, a FROM (SELECT rid, row_number() OVER (ORDER BY vec_id NULLS LAST, v) - 1 AS e FROM k) JOIN p USING (rid) WHERE e < {entries})""",
    ]
    for r in range(rounds + 1):
        if r:
            ctes.append(f"""m{r} AS (SELECT part, e, i, sum(a[i]) AS s, count(*) AS n FROM (SELECT p.part, c.e, a, unnest(range(1, len(a) + 1)) AS i
 FROM p JOIN c{r - 1} c USING (rid, part)) GROUP BY part, e, i)""")
            ctes.append(f"""b{r} AS MATERIALIZED (SELECT b.part, b.e, coalesce(m.a, b.a) AS a FROM b{r - 1} b LEFT JOIN
 (SELECT part, e, list(CAST((s - ((s % n) + n) % n) // n AS BIGINT) ORDER BY i) AS a FROM m{r} GROUP BY part, e) m USING (part, e))""")
        ctes.append(f"""c{r} AS MATERIALIZED (SELECT rid, part, x.e AS e, x.d AS d FROM (SELECT rid, p.part, min({{'d': CAST(list_sum(list_transform(range(1, len(p.a) + 1),
 lambda i: (p.a[i] - b.a[i]) * (p.a[i] - b.a[i]))) AS BIGINT), 'e': b.e}}) AS x FROM p JOIN b{r} b ON b.part = p.part GROUP BY rid, p.part))""")
    return f"""WITH {", ".join(ctes)},
o AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM k JOIN c{rounds} USING (rid) GROUP BY rid, vec_id, label)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(array_to_string(a, ','), ',' ORDER BY part, e)) FROM b{rounds}) AS codebooks_sha256 FROM o"""


@register("op11_ball_codes", _ball_sql())
def op11(spark, sf):
    coded, books = ball_codes.encode_vectors(table(spark, sf, "embeddings"))
    digest = F.lit(ball_codes.books_digest(books)).alias("codebooks_sha256")
    return ball_codes.label_errors(coded).select("vec_id", F.lower(F.hex("code")).alias("code"), "error", "label_error", digest)


TRIE_SQL = f"""WITH r AS (SELECT conv_id AS c, coalesce(role, '') AS role, coalesce(text, '') AS txt, row_number() OVER
      (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos FROM conversations WHERE conv_id IS NOT NULL),
v AS (SELECT c, c - c % {prefix_trie.FAMILY} AS base, {CRC32.format("c")} % {prefix_trie.HEADS} AS h FROM (SELECT DISTINCT c FROM r)),
q AS (SELECT v.c, 0 AS own, r.pos, role, txt FROM v JOIN r ON r.c = v.base AND r.pos <= v.h
      UNION ALL SELECT v.c, 1, r.pos, role, txt FROM v JOIN r ON r.c = v.c AND r.pos > v.h),
s AS (SELECT c, row_number() OVER w AS d, txt, list({{'r': role, 't': txt}}) OVER (w ROWS UNBOUNDED PRECEDING) AS seq
      FROM q WINDOW w AS (PARTITION BY c ORDER BY own, pos)),
m AS (SELECT c, d, txt, md5(CAST(to_json(seq) AS VARCHAR)) AS k, md5(CAST(to_json(seq[:-2]) AS VARCHAR)) AS up FROM s
      UNION ALL SELECT c, 0, '', md5('[]'), NULL FROM v),
t AS (SELECT c, max(d) AS total FROM m GROUP BY c),
n AS (SELECT d, k, min(up) AS up, min(c) AS conv_id, count(*) AS n_convs, count(*) * 0 + (count(*) - 1) * min(strlen(txt)) AS saved FROM m GROUP BY d, k),
kids AS (SELECT d - 1 AS d, up AS k, count(*) AS n_children FROM n WHERE d > 0 GROUP BY 1, 2),
f AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN kids USING (d, k)),
roll AS (SELECT m.d, m.k, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) AS n_leaves, sum(f.saved) AS saved_tokens
         FROM f JOIN m ON m.c = f.conv_id AND m.d <= f.d GROUP BY m.d, m.k),
ends AS (SELECT m.d, m.k, sha256(string_agg(CAST(m.c AS VARCHAR), ',' ORDER BY m.c)) AS sha FROM m JOIN t ON t.c = m.c AND t.total = m.d GROUP BY m.d, m.k)
SELECT f.conv_id, CAST(f.d AS BIGINT) AS depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, CAST(roll.n_leaves AS BIGINT) AS n_leaves,
       CAST(roll.saved_tokens AS BIGINT) AS saved_tokens, coalesce(ends.sha, sha256('')) AS ends_sha256
FROM f JOIN roll USING (d, k) LEFT JOIN ends USING (d, k) LEFT JOIN n p ON p.d = f.d - 1 AND p.k = f.up"""


@register("op12_prefix_trie", TRIE_SQL)
def op12(spark, sf):
    return prefix_trie.prefix_trie(table(spark, sf, "conversations"))


@register("op13_suffix_dedup")
def op13(spark, sf):
    out = suffix_dedup.remove_repeats(table(spark, sf, "documents"), carry=["doc_id"])
    return out.select(F.col("_in0").alias("doc_id"), "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))
