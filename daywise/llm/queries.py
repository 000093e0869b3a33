"""The corpus operators applied to the given tables, whole, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..session import new_folder
from .chat_format import format_conversations, read_digests
from .decontaminate import contaminated
from .exact_dedup import equal_texts
from .fill_middle import fill_in_middle, restored
from .language_id import held_out, identify, train
from .mixing import mix
from .sharding import shard
from .shared import table
from .simhash import fingerprint_hex, near_duplicates
from .sketch import fingerprint_pairs
from .spelling import spelling_variants
from .substring_dedup import remove_repeats
from .token_output import read_index, write_tokens
from .url_filter import judge, rules

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

TOKENIZER = "byte_bpe_50k.json"
URL_RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
PROBE = "</s>[INST] ok [/INST]"


def query(f, sql: str | None = None):
    QUERIES[f.__name__] = f
    if sql:
        SQL[f.__name__] = sql
    return f


def sql_twin(sql: str):
    """Register a query together with SQL for the same rows."""
    return lambda f: query(f, sql)


def tokenizer_path(name: str = TOKENIZER) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and one of control strings, formatted, stored, and read back."""
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"), F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(PROBE).alias("text"),
    )
    path = new_folder(spark, "chat-windows")
    format_conversations(turns.unionByName(probe), tokenizer_path()).write.parquet(path)
    return read_digests(spark, path)


@query
def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the sentences of spans that came before."""
    return remove_repeats(table(spark, sf_dir, "documents"))


@query
def op3_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded to files, and what the files hold of each."""
    path = new_folder(spark, "token-blocks")
    write_tokens(table(spark, sf_dir, "documents"), path, tokenizer_path())
    return read_index(spark, path)


@query
def op4_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of all documents."""
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", fingerprint_hex("fp").alias("fingerprint"), "component_id")


@query
def op5_scaled_sketch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches of all documents and their edited texts, and how alike they are."""
    return fingerprint_pairs(table(spark, sf_dir, "documents"))


@query
def op6_language_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of all documents; documents held out teach nothing."""
    docs = table(spark, sf_dir, "documents")
    return identify(docs, train(docs.filter(~held_out())))


@query
def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in eight shards along the curve."""
    placed = shard(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "hilbert"
    )


@query
def op8_entropy_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How often each document is taken."""
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


@query
def op9_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that overlap with benchmark items."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# Aliases by links with a scheme; the operator also resolves relative ones, of which these pages have none.
@sql_twin(r"""
with recursive u as (
    select page_id, url, regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*>') as canonical,
           regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*>') as moves from pages),
l as (select url as a, regexp_extract(t, '(?is)\bhref\s*=\s*["'']?([^"''\s>]+)', 1) as b from (select url, unnest(canonical) as t from u)
      union all
      select url, regexp_extract(t, '(?is)\burl\s*=\s*["'']?([^"''\s>]+)', 1) from (select url, unnest(moves) as t from u)),
f as (select a, replace(b, '&amp;', '&') as b from l where regexp_matches(b, '^[A-Za-z][A-Za-z0-9+.-]*://')),
s as (select url from pages union select a from f union select b from f),
p as (select url, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
             coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') as path,
             coalesce(regexp_extract(url, '(?s)^.*?://[^?#]*(\?[^#]*)', 1), '') as query from s),
k as (select *, host || path || query as key from p),
r(ruled, domain, start) as (values ('block', 'net', '/'), ('allow', 'example.net', '/en/'), ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
b as (select url, arg_max(struct_pack(ruled := ruled, rule := domain || start), length(domain || start)) as best
      from k join r on (host = domain or ends_with(host, '.' || domain)) and starts_with(path, start) group by url),
n as (select k.*, best.rule as rule, best.ruled as ruled from k left join b on k.url is not distinct from b.url),
e as (select x.key as a, y.key as b from f join k x on x.url = f.a join k y on y.url = f.b where x.key <> '' and y.key <> ''),
ways as (select a, b from e union select b, a from e),
reach(a, b) as (select a, a from ways union select reach.a, ways.b from reach join ways on reach.b = ways.a),
shared as (select reach.a as key, min(n.ruled) as verdict from reach join n on n.key = reach.b group by reach.a)
select page_id, n.host, n.path, n.rule, coalesce(n.ruled, shared.verdict, 'allow') as verdict,
       case when n.ruled is not null then 'rule' when shared.verdict is not null then 'alias' else 'default' end as "by"
from pages join n on pages.url is not distinct from n.url left join shared on shared.key = n.key""")
def op10_url_aliases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A verdict on the URL of all pages."""
    return judge(table(spark, sf_dir, "pages"), rules(spark, URL_RULES))


@query
def op11_spelling_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forms and roots of all words of six letters and five occurrences; some words of the texts lose a letter first."""
    return spelling_variants(table(spark, sf_dir, "documents"), slip=199)


@sql_twin("""
with d as (select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as t from documents)
select doc_id, max(doc_id) over w as keep_id, count(*) over w as group_size, doc_id = max(doc_id) over w as kept, sha256(t) as text_sha256
from d window w as (partition by t)""")
def op12_polynomial_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The row that stays for each document."""
    return equal_texts(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@sql_twin("""
with d as (select doc_id, coalesce(text, '') as t, sha256('7:' || doc_id) as h from documents),
u as (select *, regexp_extract_all(t, '[^\n]*\n|[^\n]+') as lines,
             [cast('0x' || h[8 * i + 1:8 * i + 8] as bigint) for i in range(4)] as draws from d),
c as (select *, len(lines) as n, least(draws[1] % (n + 1), draws[2] % (n + 1)) as a, greatest(draws[1] % (n + 1), draws[2] % (n + 1)) as b,
             case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or draws[3] % 100 >= 100 then 'plain'
                  when draws[4] % 100 < 50 then 'spm' else 'psm' end as form from u),
p as (select *, array_to_string(lines[1:a], '') as prefix, array_to_string(lines[a + 1:b], '') as middle,
             array_to_string(lines[b + 1:], '') as suffix from c)
select doc_id, n, form, case when form <> 'plain' then length(prefix) end as prefix_chars,
       case when form <> 'plain' then length(middle) end as middle_chars,
       sha256(case form when 'plain' then t when 'psm' then '<P>' || prefix || '<S>' || suffix || '<M>' || middle
              else '<S>' || suffix || '<P>' || prefix || '<M>' || middle end) as output_sha256,
       sha256(t) as restored_sha256
from p""")
def op13_wavelet_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut by lines, put together with the middle last, and restored from that."""
    made = fill_in_middle(table(spark, sf_dir, "documents"))
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
        F.sha2(restored(), 256).alias("restored_sha256"),
    )
