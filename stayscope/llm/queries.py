"""The registered query of each dealt operator and its DuckDB oracle.

Each query applies its operator to the whole table and derives the contract's
digest columns from the operator's output.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (chat, decontaminate, divergence, fingerprints, jaccard_rtree, langid, licenses, manifest, mixing, near_dedup,
               suffix_dedup, suffix_tree_lm, toxicity)

_UP, _LOW = decontaminate.UPPER, decontaminate.LOWER


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("carry.doc_id", "n_bytes",
                      (F.col("n_bytes") - F.length("kept")).alias("n_removed"),
                      F.size("spans").cast("long").alias("n_spans"),
                      F.sha2("kept", 256).alias("kept_sha256"))


def op2_suffix_tree_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    return suffix_tree_lm.score_texts(_table(spark, sf_dir, "documents"), held)


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)],
                                  "conv_id long, turn long, role string, text string")
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    return chat.read_back(*chat.format_conversations(rows.union(extra)))


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target",
                        (F.size("draws") * F.col("size")).cast("long").alias("taken"), "source",
                        F.col("draws")["shard"].alias("shards"))


def op5_jaccard_rtree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_rtree.jaccard_components(_table(spark, sf_dir, "documents"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return toxicity.severity(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(_table(spark, sf_dir, "documents"),
                                      _table(spark, sf_dir, "benchmark"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints.fingerprints(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
                      "edited_fingerprint", "near_edited", "near_next")


def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(_table(spark, sf_dir, "documents"))


def op10_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    held = F.crc32(F.col("doc_id").cast("string")) % 4 == 2
    out = langid.identify(docs, held_out=held)
    return out.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"),
                      "lang_pred", "score", "bits_per_byte")


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op13_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    made = manifest.build(_table(spark, sf_dir, "documents"), where=tampered,
                          changes={"n_chars": F.col("n_chars") + 1})
    return made.proofs().withColumnRenamed("id", "doc_id")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_suffix_dedup": op1_suffix_dedup,
    "op2_suffix_tree_lm": op2_suffix_tree_lm,
    "op3_chat": op3_chat,
    "op4_mixing": op4_mixing,
    "op5_jaccard_rtree": op5_jaccard_rtree,
    "op6_toxicity": op6_toxicity,
    "op7_decontaminate": op7_decontaminate,
    "op8_fingerprints": op8_fingerprints,
    "op9_licenses": op9_licenses,
    "op10_langid": op10_langid,
    "op11_divergence": op11_divergence,
    "op12_near_dedup": op12_near_dedup,
    "op13_manifest": op13_manifest,
}


def _words_sql(text: str) -> str:
    return (f"list_filter(string_split_regex(translate(coalesce({text}, ''), '{_UP}', '{_LOW}'), "
            r"'[\x20\x09-\x0D]+'), lambda x: x <> '')")


def _grams_sql(table: str, key: str, k: int) -> str:
    return (f"SELECT DISTINCT {key}, unnest(list_transform(range(1, len(ws) - {k - 2}), "
            f"lambda i: array_to_string(ws[i:i + {k - 1}], ' '))) AS s "
            f"FROM (SELECT {key}, {_words_sql('text')} AS ws FROM {table}) WHERE len(ws) >= {k}")


def _jaccard_sql(k: int, percent: int, more: str = "") -> str:
    """Components of the texts' k-word shingle sets, by an exact prefix join."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, {_words_sql('text')} AS ws FROM documents),
  s AS (SELECT doc_id, CASE WHEN len(ws) >= {k} THEN list_distinct(list_transform(range(1, len(ws) - {k - 2}),
               lambda i: array_to_string(ws[i:i + {k - 1}], ' ')))
               WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END AS sh FROM w),
  n AS (SELECT doc_id, len(sh) AS n_shingles, md5(list_sort(sh)::VARCHAR) AS fp FROM s),
  c AS (SELECT fp, min(doc_id) AS rep, any_value(n_shingles) AS n FROM n WHERE n_shingles > 0 GROUP BY fp),
  g AS (SELECT rep, n, unnest(sh) AS x FROM c JOIN s ON s.doc_id = c.rep),
  df AS (SELECT x, count(*) AS f FROM g GROUP BY x HAVING count(*) > 1),
  r AS (SELECT g.rep, g.n, g.x, row_number() OVER (PARTITION BY g.rep ORDER BY coalesce(f, 1), g.x) AS k
        FROM g LEFT JOIN df USING (x)),
  p AS (SELECT * FROM r WHERE k <= n - ceil({percent / 100} * n) + 1),
  cand AS (SELECT DISTINCT a.rep AS a, b.rep AS b, a.n AS na, b.n AS nb FROM p a JOIN p b USING (x)
           WHERE a.rep < b.rep AND 100 * least(a.n, b.n) >= {percent} * greatest(a.n, b.n)),
  link AS (SELECT a, b FROM cand JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b
           WHERE 100 * len(list_intersect(sa.sh, sb.sh))
              >= {percent} * (na + nb - len(list_intersect(sa.sh, sb.sh)))),
  e AS (SELECT a, b FROM link UNION SELECT b, a FROM link),
  reach AS (SELECT rep AS a, rep AS b FROM c WHERE rep IN (SELECT a FROM e)
            UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a),
  comp AS (SELECT a AS rep, min(b) AS component FROM reach GROUP BY a)
SELECT n.doc_id, n_shingles::BIGINT AS n_shingles, coalesce(component, c.rep, n.doc_id) AS component_id{more}
FROM n LEFT JOIN c USING (fp) LEFT JOIN comp USING (rep)"""


def _tree_sql(text: str) -> str:
    """Struct (fp, leaves, root) of a text's Merkle tree."""
    paras = (f"list_transform(string_split({text}, chr(10)), lambda p: {{'l': list_transform(regexp_extract_all("
             f"p, '[^.!?]{{1,120}}[.!?]{{0,60}}|[.!?]{{1,60}}'), lambda x: md5(x)[1:8] || printf('%02x', length(x))), 'd': md5(p)}})")
    body = ("array_to_string(list_transform({p}, lambda q: array_to_string(q.l, '.') || ';' || "
            "CASE WHEN q.d[1] IN ('0', '8') THEN '|' ELSE '' END), '')")
    return (f"list_transform([{paras}], lambda ps: {{'root': sha256(array_to_string(list_transform(ps, lambda q: q.d), '')), "
            f"'leaves': list_distinct(flatten(list_transform(ps, lambda q: q.l))), "
            f"'sections': array_to_string(list_transform(string_split({body.format(p='ps')}, '|'), "
            f"lambda s: md5(s)[1:8] || ':' || s), '|')}})[1]")


def _crc32_sql(text: str) -> str:
    """CRC-32 of an ASCII text, bit by bit (polynomial 0xEDB88320)."""
    step = "lambda x, y: xor(x >> 1, (x & 1) * 3988292384)"
    return (f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda c: ord(c)::BIGINT)), "
            f"lambda s, b: list_reduce(list_concat([xor(s, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), {step})), 4294967295::BIGINT)")


def _leaf_sql(n_chars: str) -> str:
    """The bytes of a leaf: each field with its length, ``-`` for a null."""
    return " || ".join(f"coalesce(strlen(({c})::VARCHAR)::VARCHAR || ':' || ({c})::VARCHAR, '-')"
                       for c in ("doc_id", "source", "lang", n_chars, "text"))


def _near_sql(a: str, b: str) -> str:
    chars = "coalesce(list_sum(list_transform({0}, lambda x: ('0x' || x[9:10])::BIGINT)), 0)"
    both, total = chars.format(f"list_intersect({a}.leaves, {b}.leaves)"), (
        f"({chars.format(a + '.leaves')} + {chars.format(b + '.leaves')})")
    return (f"CASE WHEN {a}.root = {b}.root THEN 1.0::DOUBLE WHEN {total} > 0 THEN "
            f"least((2 * {both})::DOUBLE / {total}::DOUBLE, 1.0::DOUBLE) ELSE 0.0::DOUBLE END")


ORACLE: dict[str, str] = {
    "op1_suffix_dedup": """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
  w AS (SELECT doc_id, i, md5(substr(h, 2 * i + 1, 400)) AS k
        FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2 - 199)) AS i FROM d WHERE length(h) >= 400)),
  r AS (SELECT doc_id, i FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)),
  j AS (SELECT doc_id, i, sum(CASE WHEN i <= p + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY doc_id ORDER BY i) AS run
        FROM (SELECT doc_id, i, coalesce(lag(i) OVER (PARTITION BY doc_id ORDER BY i), -1000) AS p FROM r)),
  s AS (SELECT doc_id, run, min(i) AS a, max(i) + 200 AS b FROM j GROUP BY doc_id, run),
  cuts AS (SELECT doc_id, list(a ORDER BY a) AS a, list(b ORDER BY a) AS b FROM s GROUP BY doc_id),
  kept AS (SELECT d.doc_id, length(h) // 2 AS n, coalesce(len(a), 0) AS n_spans,
             CASE WHEN a IS NULL THEN h ELSE array_to_string(list_transform(range(0, len(a) + 1), lambda x:
               substr(h, CASE WHEN x = 0 THEN 1 ELSE 2 * b[x] + 1 END,
                      (CASE WHEN x = len(a) THEN length(h) ELSE 2 * a[x + 1] END) - (CASE WHEN x = 0 THEN 0 ELSE 2 * b[x] END))), '')
             END AS k FROM d LEFT JOIN cuts USING (doc_id))
SELECT doc_id, n::BIGINT AS n_bytes, (n - length(k) // 2)::BIGINT AS n_removed, n_spans::BIGINT AS n_spans,
       sha256(unhex(k)) AS kept_sha256 FROM kept""",
    "op8_fingerprints": f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
  n AS (SELECT doc_id, t, coalesce(lead(t) OVER (ORDER BY doc_id DESC),
               first_value(t) OVER (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)) AS nt FROM d),
  e AS (SELECT doc_id, t, nt, substr(t, 1, length(t) - length(t) // 2) || substr(nt, 1, length(t) // 2) AS et FROM n),
  f AS (SELECT doc_id, length(t)::BIGINT AS n_chars, sha256(et) AS edited_sha256, {_tree_sql('t')} AS a,
               {_tree_sql('et')} AS b, {_tree_sql('nt')} AS c FROM e)
SELECT doc_id, n_chars, edited_sha256, a.root || '#' || a.sections AS fingerprint,
       b.root || '#' || b.sections AS edited_fingerprint, {_near_sql('a', 'b')} AS near_edited,
       {_near_sql('a', 'c')} AS near_next
FROM f""",
    "op3_chat": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL VALUES (-7, 0, 'user', '\### Assistant: </turn> ok'),
                            (-7, 1, 'assistant', '\### Assistant: </turn> ok')),
     e AS (SELECT *, replace(replace(replace(text, '\', '\\'), '#', '\#'), '</turn>', '\</turn>') AS body,
                  replace(replace(replace(replace(role, '\', '\\'), '#', '\#'), '</turn>', '\</turn>'), ':', '\:') AS head
           FROM c),
     a AS (SELECT conv_id, count(*) AS n_turns,
                  string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text) AS said,
                  coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn, role, text), '') AS loss,
                  sum(length(head) + length(body) + 14)::BIGINT AS formatted_chars
           FROM e GROUP BY conv_id)
SELECT conv_id, n_turns, sha256(said) AS turns_sha256, length(loss)::BIGINT AS loss_chars,
       sha256(loss) AS loss_sha256, formatted_chars FROM a""",
    "op7_decontaminate": f"""
WITH d AS ({_grams_sql('documents', 'doc_id', 5)}),
     i AS ({_grams_sql('benchmark', 'item_id', 5)}),
     n AS (SELECT item_id, count(*) AS n_item FROM i GROUP BY 1)
SELECT doc_id, item_id, n_item, count(*) AS n_shared, count(*) / n_item AS containment
FROM d JOIN i USING (s) JOIN n USING (item_id)
GROUP BY doc_id, item_id, n_item HAVING count(*) >= 0.8 * n_item - 1e-9
UNION ALL
SELECT DISTINCT doc_id, item_id, 1, 1, 1.0::DOUBLE
FROM (SELECT doc_id, ' ' || array_to_string({_words_sql('text')}, ' ') || ' ' AS said FROM documents) o
JOIN (SELECT item_id, {_words_sql('text')} AS ws FROM benchmark) b
  ON len(ws) BETWEEN 1 AND 4 AND contains(said, ' ' || array_to_string(ws, ' ') || ' ')""",
    "op5_jaccard_rtree": _jaccard_sql(3, 90),
    "op12_near_dedup": _jaccard_sql(5, 85, ",\n       n.doc_id = coalesce(component, c.rep, n.doc_id) AS kept"),
    "op11_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS row, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
             regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS ws FROM documents),
  t AS (SELECT row, lang, source, unnest(ws) AS term FROM d),
  k AS (SELECT lang, term, count(*) AS lang_c FROM t GROUP BY lang, term HAVING count(DISTINCT row) >= 3),
  v AS (SELECT lang, count(*) AS v, sum(lang_c) AS lang_n FROM k GROUP BY lang),
  c AS (SELECT lang, source, term, count(*) AS c FROM t JOIN k USING (lang, term) GROUP BY ALL),
  g AS (SELECT lang, source, coalesce((SELECT sum(c) FROM c WHERE c.lang = d.lang AND c.source = d.source), 0) AS n
        FROM (SELECT DISTINCT lang, source FROM d) d),
  p AS (SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
               1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 1)) // (g.n + v.v)::HUGEINT AS p
        FROM g JOIN k USING (lang) JOIN v USING (lang) LEFT JOIN c USING (lang, source, term)),
  q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (lang_c + 1)) // (lang_n + v)::HUGEINT AS q
        FROM k JOIN v USING (lang)),
  pair AS (SELECT a.lang, a.source, b.source AS item, sum(((x.p - y.p) * (x.p - y.p)) // y.p) AS value
           FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
           LEFT JOIN p x ON x.lang = a.lang AND x.source = a.source
           LEFT JOIN p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
           GROUP BY ALL),
  term AS (SELECT lang, source, term AS item, ((p - q) * (p - q)) // q AS value
           FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
  r AS (SELECT lang, source, 'pair' AS part, item, coalesce(value, 0)::BIGINT AS value FROM pair
        UNION ALL SELECT lang, source, 'term', item, value::BIGINT FROM term)
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r)
WHERE part = 'pair' OR rank <= 200""",
    "op13_manifest": f"""
WITH RECURSIVE d AS (SELECT *, {_crc32_sql('doc_id::VARCHAR')} % 7 = 0 AS tampered FROM documents),
  f AS (SELECT doc_id, lang, sha256({_leaf_sql('n_chars')}) AS leaf,
               sha256(CASE WHEN tampered THEN {_leaf_sql('n_chars + 1')} ELSE {_leaf_sql('n_chars')} END) AS changed FROM d),
  leaves AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
                    count(*) OVER (PARTITION BY lang) AS n FROM f),
  lv AS (SELECT lang, 0 AS level, pos, leaf AS h, n FROM leaves UNION ALL
         SELECT lang, level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM lv
         WHERE n > 1 GROUP BY lang, level, pos // 2, n),
  sub AS (SELECT lang, h AS subroot, level AS depth, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos,
                 count(*) OVER () AS n FROM lv WHERE n = 1),
  up AS (SELECT 0 AS level, pos, subroot AS h, n FROM sub UNION ALL
         SELECT level + 1, pos // 2, sha256(string_agg(h, '' ORDER BY pos)), (n + 1) // 2 FROM up
         WHERE n > 1 GROUP BY level, pos // 2, n),
  node AS (SELECT lang, level, pos, h FROM lv),
  walk AS (SELECT doc_id, leaf, lang, pos AS place, changed AS h, '' AS proof, 0 AS level, false AS over FROM leaves UNION ALL
           SELECT w.doc_id, w.leaf, w.lang, CASE WHEN w.over OR w.level < s.depth THEN w.place // 2 ELSE s.pos END,
             CASE WHEN NOT w.over AND w.level = s.depth THEN w.h
                  WHEN sib.h IS NULL AND up.h IS NULL THEN sha256(w.h)
                  WHEN w.place % 2 = 1 THEN sha256(coalesce(sib.h, up.h) || w.h)
                  ELSE sha256(w.h || coalesce(sib.h, up.h)) END,
             w.proof || coalesce(sib.h, up.h, ''),
             CASE WHEN NOT w.over AND w.level = s.depth THEN 0 ELSE w.level + 1 END, w.over OR w.level = s.depth
           FROM walk w JOIN sub s ON s.lang IS NOT DISTINCT FROM w.lang
           LEFT JOIN node sib ON NOT w.over AND w.level < s.depth AND sib.lang IS NOT DISTINCT FROM w.lang
                              AND sib.level = w.level AND sib.pos = xor(w.place, 1)
           LEFT JOIN up ON w.over AND up.level = w.level AND up.pos = xor(w.place, 1)
           WHERE NOT w.over OR w.level < (SELECT max(level) FROM up)),
  root AS (SELECT h AS root FROM up WHERE n = 1)
SELECT w.doc_id, w.leaf, s.subroot, r.root, sha256(w.proof) AS proof_sha256, w.h AS folded_root, w.h = r.root AS verified
FROM walk w JOIN sub s ON s.lang IS NOT DISTINCT FROM w.lang CROSS JOIN root r
WHERE w.over AND w.level = (SELECT max(level) FROM up)""",
}
