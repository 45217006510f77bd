"""The operators as registered queries over the driver's tables, with oracle SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siltworks.llm import (
    alignment,
    decontaminate,
    fingerprints,
    lines,
    mixing,
    negatives,
    ngram_join,
    personal,
    quality,
    sharding,
    substrings,
    token_counts,
    urls,
)
from siltworks.llm.tables import text_or_empty

Query = Callable[[SparkSession, str], DataFrame]

URL_RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_join(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    return quality.grade_documents(docs, quality.train(docs, quality.rated(_table(spark, sf_dir, "labels"))))


def op3_pareto_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    mix = mixing.mix_sources(_table(spark, sf_dir, "documents"), preference=mixing.length_preference())
    return mix.select("doc_id", "size", "source_size", "target", "taken", "copies", "source")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lines.dedup_lines(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substrings.dedup_substrings(_table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge_urls(_table(spark, sf_dir, "pages"), URL_RULES)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.find_leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = personal.find_personal(docs, personal.train(personal.labelled_table(docs), more=personal.examples()))
    counts = [f"n_{kind}" for kind in personal.KINDS]
    return found.select("doc_id", *counts, F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprint_edits(_table(spark, sf_dir, "documents"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    sized = docs.select("doc_id", "text", sharding.record_size().alias("size"), F.crc32(text_or_empty()).alias("text_crc32"))
    sharded = sharding.shard_documents(sized, 16)
    return sharded.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"), "vslot",
    )


def _tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(_table(spark, sf_dir, "documents"), _tokenizer("piece_bpe_32k.model"))


def op12_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, files = _table(spark, sf_dir, "documents"), ("byte_bpe_50k.json", "piece_bpe_32k.model")
    return alignment.align_tokens(docs, *map(_tokenizer, files), digest=True).withColumnRenamed("groups", "groups_sha256")


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = _table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine_negatives(vectors.withColumn("label", shifted), F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_ngram_join, op2_quality, op3_pareto_mix, op4_line_dedup, op5_substring_dedup, op6_url_filter,
        op7_decontamination, op8_personal_data, op9_fingerprints, op10_sharding, op11_token_counts, op12_token_alignment,
        op13_hard_negatives,
    )
}


def _url_oracle() -> str:
    """The longest rule that fits each page, by comparing every page with the five rules."""
    rules = " union all ".join(
        f"select '{rule}' as rule, '{rule.split('/', 1)[0]}' as rule_host, '/{rule.split('/', 1)[1]}' as rule_path,"
        f" '{verdict}' as said"
        for verdict, rule in URL_RULES
    )
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return f"""with rules as ({rules}),
rests as (select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parts as (select page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{upper}', '{upper.lower()}') as host,
                 regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') as path from rests),
fits as (select page_id, rule, said, row_number() over (partition by page_id order by length(rule) desc, length(rule_host) desc) as place
         from parts join rules on (host = rule_host or ends_with(host, '.' || rule_host)) and starts_with(path, rule_path))
select parts.page_id, host, path, rule, coalesce(said, 'allow') as verdict
from parts left join fits on parts.page_id = fits.page_id and place = 1"""


def _line_oracle() -> str:
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""with texts as (select doc_id, string_split(coalesce(text, ''), chr(10)) as ls from documents),
numbered as (select doc_id, unnest(ls) as line, generate_subscripts(ls, 1) as i from texts),
keyed as (select doc_id, line, i, translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
                 '{upper}', '{upper.lower()}') as k from numbered),
firsts as (select k, min(doc_id) as owner from keyed where length(k) >= 10 group by k),
judged as (select keyed.doc_id, line, i, owner is null or owner = keyed.doc_id as stays
           from keyed left join firsts on keyed.k = firsts.k)
select doc_id, count(*) as n_lines, count(*) filter (where not stays) as n_dropped,
       sha256(coalesce(string_agg(line, chr(10) order by i) filter (where stays), '')) as kept_sha256
from judged group by doc_id"""


def _negatives_oracle() -> str:
    """All anchors against all rows, as the test tables have them: ids once each, components NULL-free and finite."""
    return """with rows_in as (
  select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
         [floor(256 * cast(x as double)) for x in embedding] as q
  from embeddings where label is not null and embedding is not null),
scored as (select a.vec_id as anchor_id, b.vec_id as other_id, a.label = b.label as same,
                  cast(list_inner_product(a.q, b.q) as bigint) as score
           from rows_in as a join rows_in as b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id),
positives as (select * from (select anchor_id, other_id as positive_id, score as positive_score,
                                    row_number() over (partition by anchor_id order by score desc, other_id) as place
                             from scored where same) as ranked where place <= 5),
fitting as (select p.anchor_id, positive_id, positive_score, other_id as negative_id, score as negative_score,
                   row_number() over (partition by p.anchor_id, positive_id order by score desc, other_id) as place
            from positives as p join scored as s on p.anchor_id = s.anchor_id and not same
             and 80 * positive_score <= 100 * score and score <= positive_score)
select anchor_id, positive_id, cast(place as integer) as rank, negative_id, positive_score, negative_score
from fitting where place <= 5"""


ORACLES: dict[str, str] = {
    "op4_line_dedup": _line_oracle(),
    "op6_url_filter": _url_oracle(),
    "op13_hard_negatives": _negatives_oracle(),
}
