"""The operators applied to the test tables, by the contracts of their queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontamination import contaminated
from .exact_dedup import exact_groups
from .hard_negatives import hard_negatives
from .language_id import identify
from .mixing import mix
from .periodic_runs import periodic_runs
from .sharding import byte_shards
from .simhash import near_duplicates
from .substring_dedup import repeated_passages
from .suffix_dedup import repeated_bytes
from .tables import WORDS
from .token_counts import token_counts
from .toxicity import toxicity
from .url_filter import SOFT, STRICT, Rule, judge_urls


# The rules of the page contract: host, path and verdict.
PAGE_RULES = (
    Rule("com", "/", "allow"),
    Rule("example.com", "/en/", "block"),
    Rule("www.example.com", "/en/", "allow"),
    Rule("net", "/es/", "block"),
    Rule("net", "/fr/", "block"),
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_groups(_table(spark, folder, "documents"))


def op2_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    passages = repeated_passages(_table(spark, folder, "documents"), 35)
    return passages.select("doc_id", "n_words", "n_removed", "kept_sha256")


def op3_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(_table(spark, folder, "documents"))


def op4_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    strings = repeated_bytes(_table(spark, folder, "documents"), 200)
    return strings.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def op5_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return token_counts(_table(spark, folder, "documents"), ("source", "lang", "text"))


def op6_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op7_mixing(spark: SparkSession, folder: str) -> DataFrame:
    mixed = mix(_table(spark, folder, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op8_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(_table(spark, folder, "pages"), PAGE_RULES)


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return identify(_table(spark, folder, "documents"))


def op10_sharding(spark: SparkSession, folder: str) -> DataFrame:
    return byte_shards(_table(spark, folder, "documents"), 40).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op11_periodic_runs(spark: SparkSession, folder: str) -> DataFrame:
    """Words of every tenth document, by the checksum h of its id, go round from one on."""
    docs = _table(spark, folder, "documents").select("doc_id", "text")
    sums = docs.withColumn("h", F.crc32(F.col("doc_id").cast("string").cast("binary")))
    words = F.regexp_extract_all("text", F.lit(f"({WORDS})"), F.lit(1))
    split = sums.withColumn("w", F.when(F.col("h") % 10 == 0, words)).withColumn("n", F.size("w"))
    start = split.withColumn("a", F.expr("case when n > 0 then (h div 10) % n end"))
    period = start.withColumn("p", F.expr("1 + (n - a) div (3 + (h div 10) % 8)"))
    turned = "array_join(transform(sequence(0L, n - 1L), i -> w[cast(if(i < a, i, a + (i - a) % p) as int)]), ' ')"
    return periodic_runs(period.select("doc_id", F.expr(f"case when p is null then text else {turned} end").alias("text")))


def op12_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    """Anchors are every 50th vector; labels of every seventh are moved on by one."""
    vectors, number = _table(spark, folder, "embeddings"), F.col("vec_id")
    label = F.when(number % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(vectors.withColumn("label", label), number % 50 == 0)


def op13_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(_table(spark, folder, "documents"), _table(spark, folder, "labels"))


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_substring_dedup": op2_substring_dedup,
    "op3_simhash": op3_simhash,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_token_counts": op5_token_counts,
    "op6_decontamination": op6_decontamination,
    "op7_mixing": op7_mixing,
    "op8_url_filter": op8_url_filter,
    "op9_language_id": op9_language_id,
    "op10_sharding": op10_sharding,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_hard_negatives": op12_hard_negatives,
    "op13_toxicity": op13_toxicity,
}

_WORD_LISTS = r"""
d as (select doc_id, source,
             list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
      from documents)
"""


def _term_hits(terms: tuple[str, ...]) -> str:
    tests = (f"regexp_matches(u, '(^|[^a-z0-9]){t}([^a-z0-9]|$)')::bigint" for t in terms)
    return "(" + " + ".join(tests) + ")"


def _crc32(text: str) -> str:
    """The checksum of a text of ASCII characters, bit by bit."""
    steps = f"flatten(list_transform(string_split({text}, ''), lambda x: [ascii(x)::bigint, -1, -1, -1, -1, -1, -1, -1, -1]))"
    return (
        f"xor(list_reduce(list_prepend(4294967295::bigint, {steps}), "
        "lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, (c & 1) * 3988292384) end), 4294967295::bigint)"
    )


def _rule_cases(value) -> str:
    ordered = sorted(PAGE_RULES, key=lambda r: -len(r.name))
    return "case " + " ".join(
        f"when (host = '{r.host}' or ends_with(host, '.{r.host}')) and starts_with(path, '{r.path}') "
        f"then '{value(r)}'"
        for r in ordered
    ) + " end"


ORACLES: dict[str, str] = {
    "op1_exact_dedup": r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
       row_number() over (partition by t order by doc_id) = 1 as kept, sha256(t) as text_sha256
from d
""",
    "op2_substring_dedup": f"""
with {_WORD_LISTS},
windows as (select doc_id, i, array_to_string(w[i:i + 34], ' ') as s
            from (select doc_id, w, unnest(range(1, len(w) - 33)) as i from d)),
repeats as (select doc_id, i from (select doc_id, i, count(*) over (partition by s) as n from windows)
            where n > 1),
gone as (select distinct doc_id, unnest(range(i, i + 35)) as p from repeats),
words as (select doc_id, unnest(w) as word, generate_subscripts(w, 1) as p from d),
kept as (select doc_id, count(*) as n, string_agg(word, ' ' order by p) as t
         from words anti join gone using (doc_id, p) group by doc_id)
select doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed,
       sha256(coalesce(t, '')) as kept_sha256
from d left join kept using (doc_id)
""",
    "op7_mixing": f"""
with {_WORD_LISTS},
sized as (select doc_id, source, len(w)::bigint as size, md5(doc_id::varchar || ':7') as key from d),
sources as (select source, sum(size)::bigint as source_size,
                   1.0::double + (row_number() over (order by source nulls last) - 1) % 3 as weight
            from sized group by source),
levels as (select *, 3 * source_size as most,
                  ((sum(source_size) over ())::double
                   - coalesce(sum(3 * source_size) over before, 0)::double)
                  / (sum(weight) over () - coalesce(sum(weight) over before, 0.0)) as level
           from sources
           window before as (order by 3 * source_size / weight, source nulls last
                             rows between unbounded preceding and 1 preceding)),
final as (select arg_min(level, 3 * source_size / weight) as final from levels where level * weight < most),
targets as (select source, source_size,
                   case when final is null or final * weight >= most then most::double
                        else final * weight end as target
            from levels, final),
placed as (select doc_id, size, source_size, target, floor(target)::bigint as budget,
                  coalesce(sum(size) over (partition by s.source order by key
                           rows between unbounded preceding and 1 preceding), 0)::bigint as earlier
           from sized s join targets t on s.source is not distinct from t.source),
cut as (select *, case when source_size > 0 then budget // source_size else 0 end as epochs from placed)
select doc_id, size, source_size, target,
       (epochs * size + greatest(0, least(size, budget - epochs * source_size - earlier)))::bigint as taken
from cut
""",
    "op8_url_filter": f"""
with rest as (select page_id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as u,
                     case when contains(url, '://') then url[strpos(url, '://') + 3:] else '' end as r
              from pages),
parts as (select page_id, u,
                 translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
                 regexp_extract(r, '^[^/?#]*(/[^?#]*)', 1) as path,
                 {_term_hits(STRICT)} as strict_hits, {_term_hits(SOFT)} as soft_hits
          from rest)
select page_id, host, path, {_rule_cases(lambda r: r.name)} as rule,
       coalesce({_rule_cases(lambda r: r.verdict)},
                case when strict_hits > 0 or soft_hits >= 2 then 'block' else 'allow' end) as verdict,
       strict_hits, soft_hits
from parts
""",
    "op11_periodic_runs": f"""
with {_WORD_LISTS},
sums as (select doc_id, w, len(w)::bigint as n, {_crc32("doc_id::varchar")} as h from d),
planted as (select doc_id, n, w, h // 10 % greatest(n, 1) as a,
                   1 + (n - h // 10 % greatest(n, 1)) // (3 + h // 10 % 8) as p, h % 10 = 0 and n > 0 as turned
            from sums),
words as (select doc_id, i, case when turned and i >= a then w[a + (i - a) % p + 1] else w[i + 1] end as word
          from (select *, unnest(range(0, n)) as i from planted)),
same as (select x.doc_id, x.i, y.i - x.i as q from words x join words y
         on x.doc_id = y.doc_id and x.word = y.word and x.i < y.i),
stretch as (select doc_id, q, min(i) as start, count(*) + q as length
            from (select *, i - row_number() over (partition by doc_id, q order by i) as island from same)
            group by doc_id, q, island having count(*) + q >= greatest(6, 4 * q)),
runs as (select doc_id, start, length, min(q) as period from stretch group by doc_id, start, length),
lines as (select doc_id, count(*) as n_runs,
                 string_agg(concat(start, ',', length, ',', period, chr(10)), '' order by start, period) as s
          from runs group by doc_id),
best as (select * from runs qualify row_number() over (partition by doc_id
                order by length::double / period desc, start, period) = 1),
gone as (select distinct doc_id, unnest(range(start + period, start + length)) as i from runs),
kept as (select doc_id, string_agg(word, ' ' order by i) as t from words anti join gone using (doc_id, i) group by doc_id)
select sums.doc_id, coalesce(n_runs, 0)::bigint as n_runs, start::bigint as start, length::bigint as length,
       period::bigint as period, (1000 * length // period)::bigint as exponent_milli,
       sha256(coalesce(s, '')) as runs_sha256, sha256(coalesce(t, '')) as collapsed_sha256
from sums left join lines using (doc_id) left join best using (doc_id) left join kept using (doc_id)
""",
    "op12_hard_negatives": """
with v as (select vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
                  list_transform(embedding, lambda x: floor(256 * x::double)) as e
           from embeddings
           where label is not null and embedding is not null
             and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scores as (select a.vec_id as anchor_id, r.vec_id, a.label = r.label as same, list_inner_product(a.e, r.e)::bigint as score
           from v a join v r on a.vec_id % 50 = 0 and a.vec_id <> r.vec_id),
positives as (select anchor_id, vec_id as positive_id, score as positive_score from scores where same
              qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select anchor_id, positive_id,
       (row_number() over (partition by anchor_id, positive_id order by score desc, vec_id))::int as rank,
       vec_id as negative_id, positive_score, score as negative_score
from positives join scores using (anchor_id)
where not same and 50 * positive_score <= 100 * score and 100 * score <= 95 * positive_score
qualify rank <= 3
""",
}
