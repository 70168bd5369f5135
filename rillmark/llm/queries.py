"""The operators over the given tables, with their production parameters."""

from __future__ import annotations

from rillmark.llm import licenses, secrets
from rillmark.llm.collocations import collocations
from rillmark.llm.decontamination import contaminated
from rillmark.llm.embeddings import cosine_links
from rillmark.llm.frames import given
from rillmark.llm.jaccard import jaccard_components
from rillmark.llm.merkle import verified_manifest
from rillmark.llm.mixing import mix_sources
from rillmark.llm.quality import quality
from rillmark.llm.registry import query
from rillmark.llm.tokens import written_and_read
from rillmark.llm.toxicity import toxicity
from rillmark.llm.urls import filter_urls
from rillmark.llm.warc import archived


@query()
def op5_mixing(spark, sf_dir):
    mixed = mix_sources(given(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query()
def op9_secrets(spark, sf_dir):
    return secrets.with_digests(secrets.find_secrets(given(spark, sf_dir, "documents")))


@query()
def op4_licenses(spark, sf_dir):
    return licenses.with_joined_labels(licenses.scan_licenses(given(spark, sf_dir, "documents")))


@query()
def op10_toxicity(spark, sf_dir):
    return toxicity(given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels"))


@query()
def op8_quality(spark, sf_dir):
    return quality(given(spark, sf_dir, "documents"), given(spark, sf_dir, "labels"))


@query(r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws
  FROM documents),
s AS (SELECT DISTINCT doc_id, unnest([array_to_string(list_slice(ws, i, i + 3), ' ') for i in range(1, greatest(len(ws) - 3, 1) + 1)]) AS g
  FROM w WHERE len(ws) > 0),
n AS (SELECT doc_id, count(*) AS c FROM s GROUP BY doc_id),
o AS (SELECT a.doc_id AS u, b.doc_id AS v, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY ALL),
l AS (SELECT o.u, o.v FROM o JOIN n x ON x.doc_id = o.u JOIN n y ON y.doc_id = o.v WHERE 100 * o.c >= 85 * (x.c + y.c - o.c)),
r AS (SELECT doc_id AS id, doc_id AS reached FROM w UNION SELECT r.id, l.v FROM r JOIN l ON l.u = r.reached)
SELECT r.id AS doc_id, coalesce(any_value(n.c), 0) AS n_shingles, min(r.reached) AS component_id
FROM r LEFT JOIN n ON n.doc_id = r.id GROUP BY r.id
""")
def op6_jaccard(spark, sf_dir):
    return jaccard_components(given(spark, sf_dir, "documents"))


@query("""
WITH RECURSIVE v AS (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len([x for x in embedding if x IS NULL OR NOT isfinite(x)]) = 0 AND len([x for x in embedding if x <> 0]) > 0),
n AS (SELECT vec_id, e, sqrt(list_inner_product(e, e)) AS norm FROM v),
l AS (SELECT a.vec_id AS u, b.vec_id AS w FROM n a JOIN n b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
  WHERE list_inner_product(a.e, b.e) / (a.norm * b.norm) >= 0.9),
r AS (SELECT vec_id AS id, vec_id AS reached FROM embeddings UNION SELECT r.id, l.w FROM r JOIN l ON l.u = r.reached),
c AS (SELECT id, min(reached) AS component_id FROM r GROUP BY id),
k AS (SELECT u, count(*) AS n_links FROM l GROUP BY u)
SELECT c.id AS vec_id, coalesce(k.n_links, 0) AS n_links, c.component_id, c.id = c.component_id AS kept FROM c LEFT JOIN k ON k.u = c.id
""")
def op1_embeddings(spark, sf_dir):
    return cosine_links(given(spark, sf_dir, "embeddings"))


@query()
def op2_decontamination(spark, sf_dir):
    return contaminated(given(spark, sf_dir, "documents"), given(spark, sf_dir, "benchmark"))


@query()
def op3_urls(spark, sf_dir):
    return filter_urls(given(spark, sf_dir, "pages"), given(spark, sf_dir, "labels"))


@query("""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
d AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS first FROM d)
SELECT page_id, payload_bytes,
  array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + ((CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS INTEGER) >> (15 - 5 * (i % 4))) & 31), 1)
    for i in range(0, 32)], '') AS payload_digest,
  CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type, CASE WHEN page_id <> first THEN first END AS refers_to
FROM f
""")
def op7_warc(spark, sf_dir):
    return archived(given(spark, sf_dir, "pages")).drop("record_id")


_LEAF = """sha256(concat(
  CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END, CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END,
  CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END, CASE WHEN n_chars IS NULL THEN '-' ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END,
  CASE WHEN {0} IS NULL THEN '-' ELSE strlen({0}) || ':' || {0} END))"""
#: One run of a level: what stands before and behind a node.
_RUN = "coalesce(string_agg(node, '') OVER (PARTITION BY {0}l, pos // 3 ORDER BY pos ROWS BETWEEN {1}), '')"
_BEFORE, _BEHIND = "UNBOUNDED PRECEDING AND 1 PRECEDING", "1 FOLLOWING AND UNBOUNDED FOLLOWING"


@query(f"""
WITH RECURSIVE c AS (
  SELECT *, replace(text, chr(10), '') AS cut, xor(list_reduce(
    list_prepend(4294967295, flatten([[ascii(b), -1, -1, -1, -1, -1, -1, -1, -1] for b in regexp_extract_all(CAST(doc_id AS VARCHAR), '.')])),
    lambda s, x: CASE WHEN x >= 0 THEN xor(s, x) WHEN s % 2 = 1 THEN xor(s // 2, 3988292384) ELSE s // 2 END), 4294967295) % 2 = 0 AS even
  FROM documents),
p AS (SELECT doc_id, source, leaf, start, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n
  FROM (SELECT doc_id, source, {_LEAF.format("text")} AS leaf, CASE WHEN even THEN {_LEAF.format("cut")} ELSE {_LEAF.format("text")} END AS start FROM c)),
t(source, l, pos, node, n) AS (
  SELECT source, 0, pos, leaf, n FROM p UNION ALL
  SELECT source, l + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM t WHERE n > 1 GROUP BY source, l, pos // 3, n),
sr AS (SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM t WHERE n = 1),
u(l, pos, node, n) AS (
  SELECT 0, pos, node, n FROM sr UNION ALL
  SELECT l + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (n + 2) // 3 FROM u WHERE n > 1 GROUP BY l, pos // 3, n),
ts AS (SELECT source, l, pos, {_RUN.format("source, ", _BEFORE)} AS a, {_RUN.format("source, ", _BEHIND)} AS b FROM t WHERE n > 1),
us AS (SELECT l, pos, {_RUN.format("", _BEFORE)} AS a, {_RUN.format("", _BEHIND)} AS b FROM u WHERE n > 1),
f(doc_id, source, l, pos, node) AS (
  SELECT doc_id, source, 0, pos, start FROM p UNION ALL
  SELECT f.doc_id, f.source, f.l + 1, f.pos // 3, sha256(a || f.node || b) FROM f JOIN ts ON ts.source IS NOT DISTINCT FROM f.source AND ts.l = f.l AND ts.pos = f.pos),
g(doc_id, l, pos, node) AS (
  SELECT f.doc_id, 0, sr.pos, f.node FROM (SELECT doc_id, source, arg_max(node, l) AS node FROM f GROUP BY ALL) f JOIN sr ON sr.source IS NOT DISTINCT FROM f.source UNION ALL
  SELECT g.doc_id, g.l + 1, g.pos // 3, sha256(a || g.node || b) FROM g JOIN us ON us.l = g.l AND us.pos = g.pos),
e AS (SELECT doc_id, arg_max(node, l) AS folded_root FROM g GROUP BY doc_id),
s AS (
  SELECT p.doc_id, 0 AS tree, ts.l, a || b AS ab FROM p JOIN ts ON ts.source IS NOT DISTINCT FROM p.source AND ts.pos = p.pos // CAST(3 ** ts.l AS BIGINT) UNION ALL
  SELECT p.doc_id, 1, us.l, a || b FROM p JOIN sr ON sr.source IS NOT DISTINCT FROM p.source JOIN us ON us.pos = sr.pos // CAST(3 ** us.l AS BIGINT)),
pr AS (SELECT doc_id, string_agg(ab, '' ORDER BY tree, l) AS proof FROM s GROUP BY doc_id)
SELECT p.doc_id, p.leaf, sr.node AS subroot, u.node AS root, sha256(coalesce(pr.proof, '')) AS proof_sha256, e.folded_root, e.folded_root = u.node AS verified
FROM p JOIN sr ON sr.source IS NOT DISTINCT FROM p.source JOIN u ON u.n = 1 JOIN e ON e.doc_id = p.doc_id LEFT JOIN pr ON pr.doc_id = p.doc_id
""")
def op12_merkle(spark, sf_dir):
    found = verified_manifest(given(spark, sf_dir, "documents"))
    return found.select("doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified")


@query()
def op11_tokens(spark, sf_dir):
    from public_tokenizers import path

    return written_and_read(given(spark, sf_dir, "documents"), path("word_bpe_49k.json"), end_id=1)


@query(r"""
WITH t AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM t),
tot AS (SELECT lang, CAST(sum(len(ws)) AS BIGINT) AS n FROM w GROUP BY lang),
g AS (SELECT lang, unnest(flatten([[array_to_string(list_slice(ws, i, i + k - 1), ' ') for i in range(1, len(ws) - k + 2)] for k in range(1, 6)])) AS phrase FROM w),
f AS (SELECT lang, phrase, count(*) AS a, string_split(phrase, ' ') AS ws FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT * FROM f WHERE len(ws) > 1),
cut AS (SELECT lang, phrase, a, ws, k, array_to_string(list_slice(ws, 1, k), ' ') AS first, array_to_string(list_slice(ws, k + 1, len(ws)), ' ') AS rest
  FROM (SELECT *, unnest(range(1, len(ws))) AS k FROM c)),
s AS (SELECT cut.lang, cut.phrase, cut.a, x.a AS l, y.a AS r, tot.n, CAST((CAST(1000 AS HUGEINT) * cut.a * tot.n) // (CAST(x.a AS HUGEINT) * y.a) AS BIGINT) AS score, k
  FROM cut JOIN f x ON x.lang = cut.lang AND x.phrase = cut.first JOIN f y ON y.lang = cut.lang AND y.phrase = cut.rest JOIN tot ON tot.lang = cut.lang),
low AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM low WHERE NOT EXISTS (
  SELECT 1 FROM c WHERE c.lang = low.lang AND length(c.phrase) > length(low.phrase) AND contains(' ' || c.phrase || ' ', ' ' || low.phrase || ' ') AND 100 * c.a >= 100 * low.a)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= 2000
""")
def op13_collocations(spark, sf_dir):
    return collocations(given(spark, sf_dir, "documents"), least=100, depth=5, top=2000, covered=100).drop("k")
