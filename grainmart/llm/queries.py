"""The registered queries of this subpackage, with their oracle SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from grainmart.llm import byte_bpe, conversation_repair, decontaminate, exact_dedup, hilbert_shards, license_scan, lm_score
from grainmart.llm import mix_sources, ngram_join, quality_rules, token_counts, toxicity, vector_codes
from grainmart.llm.common import table

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), digest_all=True).select(
        "doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op3_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_score.lm_scores(table(spark, sf_dir, "documents"))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources.mix_sources(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken", "source", "copies")


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"), RANKS, public_tokenizers.PATTERN)


def op6_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_groups(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.edited_counts(table(spark, sf_dir, "documents"), token_counts.copying_edits(),
                                      RANKS, public_tokenizers.PATTERN)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hilbert_shards.curve_shards(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "curve")


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "posterior")


def op11_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vector_codes.code_report(table(spark, sf_dir, "embeddings"))


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations")
    return conversation_repair.repair_report(conversation_repair.damaged(conversations), conversations)


QUERIES = {f.__name__: f for f in (
    op1_exact_dedup, op2_license_scan, op3_lm_score, op4_mix_sources, op5_byte_bpe, op6_ngram_join,
    op7_token_counts, op8_toxicity, op9_hilbert_shards, op10_quality_rules, op11_decontaminate, op12_vector_codes,
    op13_conversation_repair)}


def _lloyd_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """Lloyd's rounds written out: each round assigns all parts anew, by definition and without any pruning."""
    assign = """
             a{r} AS MATERIALIZED (SELECT p.id, p.part, p.label, p.vec_id, p.v, min(struct_pack(
                        d := list_sum(list_transform(list_zip(p.v, b.v), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), entry := b.entry)) AS best
                      FROM p JOIN b{r} b USING (part) GROUP BY ALL)"""
    update = """
             c{r} AS (SELECT part, best.entry AS entry, k, floor(sum(v[k]) / count(*)::DOUBLE)::BIGINT AS x
                      FROM a{r}, range(1, len(v) + 1) t(k) GROUP BY 1, 2, 3),
             m{r} AS (SELECT part, entry, list(x ORDER BY k) AS v FROM c{r} GROUP BY 1, 2),
             b{n} AS MATERIALIZED (SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM b{r} b LEFT JOIN m{r} m USING (part, entry))"""
    steps = [assign.format(r=0)]
    for r in range(rounds):
        steps += [update.format(r=r, n=r + 1), assign.format(r=r + 1)]
    return f"""
        WITH kept AS (SELECT row_number() OVER (ORDER BY vec_id) - 1 AS id, vec_id, label,
                             list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS ints FROM embeddings
                      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
             p AS MATERIALIZED (SELECT id, vec_id, label, part, ints[part * (len(ints) // 4) + 1:(part + 1) * (len(ints) // 4)] AS v
                  FROM kept, range(4) t(part)),
             b0 AS (SELECT part, id AS entry, v FROM p WHERE id < 256),{','.join(steps)},
             e AS (SELECT id, vec_id, label, string_agg(printf('%02x', best.entry), '' ORDER BY part) AS code,
                          sum(best.d)::BIGINT AS error FROM a{rounds} GROUP BY 1, 2, 3)
        SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
               (SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) FROM b{rounds}) AS codebooks_sha256 FROM e"""


def _repair_sql() -> str:
    """The least-cost edits by a recursion from the last row back that carries cost, audit and text of each state.

    Of a state's ways at a row, up to two insertions and one edit of the row, the least by (cost, audit) stays.
    """
    roles, follow = {"u": "user", "a": "assistant"}, conversation_repair.FOLLOW
    ways = []
    for q in range(4):
        here, audit, made, cost, options = q, "", "", 0, []
        for _ in range(3):
            lead = f"{cost} + w.s[{here + 1}].c"
            tail = f"w.s[{here + 1}]"
            options.append(f"struct_pack(c := {lead} + 4, a := '{audit}D' || {tail}.a, t := '{made}' || {tail}.t)")
            for (state, initial), then in follow.items():
                if state == here:
                    tail = f"w.s[{then + 1}]"
                    options.append(
                        f"CASE WHEN r.fault < 2 AND r.i = '{initial}' THEN struct_pack(c := {cost} + 3 * r.fault + {tail}.c, "
                        f"a := '{audit}K' || {tail}.a, t := '{made}' || chr(10) || r.role || ':' || r.text || {tail}.t) END")
            role, then = conversation_repair.NEXT_ROLE[here], conversation_repair.FORCED[here]
            tail = f"w.s[{then + 1}]"
            options.append(
                f"CASE WHEN r.fault < 2 THEN struct_pack(c := {cost} + 3 + 3 * r.fault + {tail}.c, a := '{audit}R' || {tail}.a, "
                f"t := '{made}' || chr(10) || '{roles[role]}:' || r.text || {tail}.t) END")
            audit, made, cost, here = audit + "I", f"{made}' || chr(10) || '{roles[role]}:", cost + 3, then
        ways.append(f"list_min(list_filter([{', '.join(options)}], lambda x: x IS NOT NULL))")
    end = ["struct_pack(c := 0, a := '', t := '')",
           "struct_pack(c := 6, a := 'II', t := chr(10) || 'user:' || chr(10) || 'assistant:')",
           "struct_pack(c := 3, a := 'I', t := chr(10) || 'assistant:')", "struct_pack(c := 0, a := '', t := '')"]
    return rf"""
        WITH RECURSIVE crc_table AS MATERIALIZED (
               WITH RECURSIVE c AS (SELECT i, i::BIGINT AS v, 0 AS k FROM range(256) t(i)
                 UNION ALL SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM c WHERE k < 8)
               SELECT list(v ORDER BY i) AS t FROM c WHERE k = 8),
             raw AS (SELECT row_number() OVER () AS id, conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                            coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k FROM conversations),
             drawn AS (SELECT raw.*, xor(list_reduce([4294967295::BIGINT] || list_transform(string_split(k, ''), lambda ch: ascii(ch)::BIGINT),
                              lambda h, x: xor(t[((xor(h, x)) & 255) + 1], h >> 8)), 4294967295) % 20 AS d FROM raw, crc_table),
             hit AS (SELECT id, copy, conv_id, turn, CASE WHEN d = 4 THEN 'user' ELSE role END AS role,
                            CASE WHEN d = 1 THEN '' WHEN d = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
                     FROM drawn, range(2) t(copy) WHERE d <> 0 AND (copy = 0 OR d = 3)),
             n AS (SELECT *, row_number() OVER o AS p, count(*) OVER (PARTITION BY conv_id) AS rows,
                          row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, id, copy) AS nth,
                          CASE WHEN role[1] IN ('s', 'u', 'a') THEN role[1] ELSE '-' END AS i,
                          rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS cut
                   FROM hit WINDOW o AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
                                       sha256(length(role)::VARCHAR || ':' || role || text)[:32], id, copy)),
             f AS (SELECT *, CASE WHEN cut = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate'
                                  WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 'truncated' END AS kind,
                          CASE WHEN cut = '' OR nth > 1 THEN 2 WHEN right(cut, 1) NOT IN ('.', '!', '?') THEN 1 ELSE 0 END AS fault,
                          lag(i) OVER (PARTITION BY conv_id ORDER BY p) || i AS pair FROM n),
             w AS (SELECT DISTINCT conv_id, rows + 1 AS p, [{', '.join(end)}] AS s FROM f
                   UNION ALL
                   SELECT w.conv_id, r.p, [{', '.join(ways)}] AS s
                   FROM w JOIN f r ON r.conv_id IS NOT DISTINCT FROM w.conv_id AND r.p = w.p - 1),
             stats AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                              count(*) FILTER (kind = 'blank') AS blank, count(*) FILTER (kind = 'duplicate') AS duplicate,
                              count(*) FILTER (kind = 'truncated') AS truncated,
                              count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal FROM f GROUP BY conv_id),
             ids AS (SELECT DISTINCT conv_id FROM conversations)
        SELECT ids.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(s[1].c, 0)::BIGINT AS cost,
               coalesce(s[1].a, '') AS audit, sha256(coalesce(s[1].t[2:], '')) AS repaired_sha256
        FROM ids LEFT JOIN stats ON stats.conv_id IS NOT DISTINCT FROM ids.conv_id
        LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM ids.conv_id AND w.p = 1"""


ORACLE = {
    "op1_exact_dedup": r"""
        WITH t AS (SELECT doc_id, length(coalesce(text, '')) AS points,
                          sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
                   FROM documents),
             r AS (SELECT *, row_number() OVER w AS place, first_value(doc_id) OVER w AS keep_id,
                          count(*) OVER (PARTITION BY text_sha256) AS group_size
                   FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY points DESC, doc_id))
        SELECT doc_id, keep_id, group_size, place = 1 AS kept, text_sha256 FROM r""",
    "op6_ngram_join": r"""
        WITH RECURSIVE w AS (
               SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                      'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
             s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) = 0 THEN [] WHEN len(words) < 5 THEN [words]
                      ELSE [words[i:i + 4] FOR i IN range(1, len(words) - 3)] END) AS shingle FROM w),
             n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
             p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common FROM s a JOIN s b
                   ON a.shingle = b.shingle AND a.doc_id <> b.doc_id GROUP BY 1, 2),
             links AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
                       WHERE 100 * common >= 80 * (x.n + y.n - common)),
             reach AS (SELECT doc_id AS a, doc_id AS b FROM documents
                       UNION SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b)
        SELECT reach.a AS doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(reach.b) AS component_id
        FROM reach LEFT JOIN n ON n.doc_id = reach.a GROUP BY reach.a""",
    "op11_decontaminate": r"""
        WITH d AS (SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM documents),
             i AS (SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''),
                     'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark),
             q AS (SELECT DISTINCT item, unnest(CASE WHEN len(words) < 10 THEN [words]
                     ELSE [words[k:k + 9] FOR k IN range(1, len(words) - 8)] END) AS run FROM i WHERE len(words) > 0),
             n AS (SELECT DISTINCT len(run) AS n FROM q),
             p AS (SELECT r, n, unnest(range(1, len(words) - n + 2)) AS k, words[k:k + n - 1] AS run FROM d, n),
             m AS MATERIALIZED (SELECT r, k, n, item FROM p JOIN q USING (run)),
             h AS (SELECT r, count(*) AS n_hit FROM (SELECT DISTINCT r, unnest(range(k, k + n)) FROM m) GROUP BY r),
             s AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
                   FROM (SELECT DISTINCT r, item FROM m) GROUP BY r)
        SELECT doc_id, len(words) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM d LEFT JOIN h USING (r) LEFT JOIN s USING (r)""",
    "op12_vector_codes": _lloyd_sql(),
    "op13_conversation_repair": _repair_sql(),
}
