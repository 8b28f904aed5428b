"""The operators applied to the given tables, and DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from harborline.llm import fill_middle, fingerprints, mixing, near_dup, packing, pii, quality, runs, suffix_dedup, token_count, topk, toxicity, url_filter
from harborline.llm.common import WORD, table

#: The rules of the pages query, as (verdict, host, path).
URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select(F.col("row.doc_id").alias("doc_id"), "size", "source_size", "target", "taken")


def op2_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.against_edits(table(spark, sf_dir, "documents"))


def op2_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pairs of different fingerprints of whole texts that differ in three bits at most."""
    return fingerprints.within(fingerprints.fingerprints(table(spark, sf_dir, "documents")), radius=3)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.drop_repeats(table(spark, sf_dir, "documents"))


def op6_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_dup.groups(table(spark, sf_dir, "documents"))
    return found.select("doc_id", near_dup.unsigned_hex(F.col("fp")).alias("fingerprint"), "component_id")


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer(packing.TOKENIZER))


def op8_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "verdict string, host string, path string")
    return url_filter.judge(table(spark, sf_dir, "pages"), rules)


def op9_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.report(pii.find(table(spark, sf_dir, "documents")))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count.count_tokens(table(spark, sf_dir, "documents"), tokenizer(token_count.TOKENIZER))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = fill_middle.fill_in_middle(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"),
    )


def op12_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def with_repeated_tails(docs: DataFrame) -> DataFrame:
    """Documents of which one in ten goes on repeating a stretch of its words, as the contract of the run query asks."""
    drawn = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(1))
    g, n = F.floor(drawn / 10), F.size("_words")
    words = docs.select(
        "doc_id", "text", g.alias("_g"),
        F.when(drawn % 10 == 0, F.regexp_extract_all("text", F.lit(f"({WORD})"))).alias("_words"),
    )
    start = (F.col("_g") % n).cast("int")
    period = (F.lit(1) + F.floor((n - F.col("_start")) / (F.lit(3) + F.col("_g") % 8))).cast("int")
    at = F.transform(F.sequence(F.col("_start"), n - 1), lambda i: F.get("_words", F.col("_start") + (i - F.col("_start")) % F.col("_period")))
    tail = F.array_join(F.concat(F.slice("_words", F.lit(1), F.col("_start")), at), " ")
    placed = words.withColumn("_start", F.when(n > 0, start)).withColumn("_period", period)
    return placed.select("doc_id", F.when(n > 0, tail).otherwise(F.col("text")).alias("text"))


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = runs.collapse_runs(with_repeated_tails(table(spark, sf_dir, "documents"))).withColumn("_best", runs.strongest(F.col("runs")))
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "_best.start", "_best.length", "_best.period",
        F.floor(F.lit(1000) * F.col("_best.length") / F.col("_best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = [
        op1_mixing, op2_fingerprints, op2_neighbours, op3_topk, op4_toxicity, op5_repeats, op6_simhash_groups, op7_packing,
        op8_url_rules, op9_personal_data, op10_token_counts, op11_fill_middle, op12_quality, op13_periodic_runs,
    ]
    return {q.__name__: q for q in own}


SQL = {
    "op1_mixing": r"""
        with sized as (
          select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size,
            cast('0x' || substr(md5('mix-1:' || coalesce(cast(doc_id as varchar), '')), 1, 15) as bigint) as h
          from documents),
        sources as (
          select source, cast(sum(size) as bigint) as source_size,
            [5, 2, 1][cast((row_number() over (order by source is null, source) - 1) % 3 + 1 as int)] as weight
          from sized group by source),
        ranked as (
          select *, sum(source_size) over () as total, sum(weight) over () as all_weight,
            coalesce(sum(3 * source_size) over before, 0) as held, coalesce(sum(weight) over before, 0) as gone
          from sources window before as (order by source_size / weight, source is null, source rows between unbounded preceding and 1 preceding)),
        level as (
          select cast(total - sum(case when clamped then 3 * source_size else 0 end) as bigint) as rest,
            sum(case when clamped then 0 else weight end) as open_weight
          from (select *, 3 * source_size * (all_weight - gone) < weight * (total - held) as clamped from ranked) group by total),
        targets as (
          select source, source_size, case when 3 * source_size * open_weight < weight * rest then cast(3 * source_size as double)
            else cast(weight * rest as double) / cast(open_weight as double) end as target
          from sources, level),
        goals as (
          select *, cast(floor(target + 0.5) as bigint) as goal, cast(floor(target + 0.5) as bigint) // greatest(source_size, 1) as whole
          from targets)
        select doc_id, cast(size as bigint) as size, source_size, target,
          cast(whole * size + greatest(0, least(size, goal - whole * greatest(source_size, 1) - (sum(size) over (
            partition by s.source order by h, doc_id nulls last, size rows between unbounded preceding and current row) - size))) as bigint) as taken
        from sized s join goals g on s.source is not distinct from g.source""",
    "op3_topk": """
        with v as (
          select distinct vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v from embeddings
          where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
          select q.vec_id as query_id, c.vec_id, cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
          from v q join v c on q.vec_id % 50 = 0 and c.vec_id is distinct from q.vec_id)
        select query_id, cast(rank as int) as rank, vec_id, score from (
          select *, row_number() over (partition by query_id order by score desc, vec_id) as rank from scored) where rank <= 5""",
    "op8_url_rules": r"""
        with urls as (
          select page_id, case when position('://' in url) > 0 then substr(url, position('://' in url) + 3) else '' end as rest from pages),
        cut as (
          select page_id, regexp_extract(rest, '^[^/?#]*') as host, rest from urls),
        pieces as (
          select page_id, translate(host, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
            regexp_extract(substr(rest, length(host) + 1), '^[^?#]*') as path from cut),
        rules(verdict, rule_host, rule_path) as (values
          ('allow', 'com', '/'), ('block', 'example.com', '/en/'), ('allow', 'www.example.com', '/en/'),
          ('block', 'net', '/es/'), ('block', 'net', '/fr/')),
        fits as (
          select page_id, arg_max(struct_pack(rule := rule_host || rule_path, verdict := verdict), length(rule_host || rule_path)) as best
          from pieces, rules
          where (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path) group by page_id)
        select p.page_id, host, path, best.rule as rule, coalesce(best.verdict, 'allow') as verdict from pieces p left join fits f using (page_id)""",
    "op11_fill_middle": r"""
        with drawn as (
          select doc_id, coalesce(text, '') as text, sha256('1:' || coalesce(cast(doc_id as varchar), '')) as hex,
            regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as tokens from documents),
        numbers as (
          select *, len(tokens) as n, cast('0x' || substr(hex, 1, 8) as bigint) as h1, cast('0x' || substr(hex, 9, 8) as bigint) as h2,
            cast('0x' || substr(hex, 17, 8) as bigint) as h3, cast('0x' || substr(hex, 25, 8) as bigint) as h4 from drawn),
        cuts as (
          select *, least(h1 % (n + 1), h2 % (n + 1)) as low, greatest(h1 % (n + 1), h2 % (n + 1)) as high,
            case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h3 % 100 >= 90 then 'plain'
              when h4 % 100 < 20 then 'spm' else 'psm' end as form
          from numbers),
        parts as (
          select doc_id, n, form, text, coalesce(array_to_string(tokens[1:low], ''), '') as p,
            coalesce(array_to_string(tokens[low + 1:high], ''), '') as m, coalesce(array_to_string(tokens[high + 1:n], ''), '') as s
          from cuts)
        select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then cast(length(p) as bigint) end as prefix_chars,
          case when form <> 'plain' then cast(length(m) as bigint) end as middle_chars,
          sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m
            else '<S>' || s || '<P>' || p || '<M>' || m end) as output_sha256,
          sha256(text) as restored_sha256
        from parts""",
}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
