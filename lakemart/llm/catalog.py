"""The registered queries of this folder, each with its SQL equivalent where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakemart.catalog.registry import Entry, Source
from lakemart.llm import collocations, credentials, exact, idfiles, langid, licenses, minhash, mixing, packing, passages, pivots, warc, whitening
from lakemart.llm.common import let_workers_import
from lakemart.session import scratch_path

QUERIES: dict[str, Entry] = {}


def query(sql: str | None = None):
    def register(build: Callable[[Source], DataFrame]) -> Callable[[Source], DataFrame]:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            let_workers_import(spark)
            return build(Source(spark, folder))

        QUERIES[build.__name__] = Entry(run, sql)
        return build

    return register


@query()
def op1_language_id(t: Source) -> DataFrame:
    """Documents: the source stands for the host, the lang field for the declared language."""
    documents = t.documents
    found = langid.identify(documents, langid.fit(documents), declared=F.col("lang"), levels=[F.col("source")])
    return found.drop("text_hash").withColumnRenamed("id", "doc_id")


@query()
def language_id_pages(t: Source) -> DataFrame:
    """Web pages: the model of the documents' languages, html lang, country suffix and host priors."""
    suffix, domain, host = langid.host_levels(F.col("url"))
    found = langid.identify(
        t.pages, langid.fit(t.documents), "page_id", langid.page_text(F.col("html")), langid.page_language(F.col("html")), suffix,
        [suffix, domain, host])
    return found.drop("text_hash").withColumnRenamed("id", "page_id")


@query()
def op2_best_fit_packing(t: Source) -> DataFrame:
    digested = packing.pieces_of(t.documents).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return packing.packed(digested).withColumnRenamed("id", "doc_id")


@query()
def op3_secret_scan(t: Source) -> DataFrame:
    return credentials.secret_report(t.documents).select(
        F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex",
        F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256"), "spans",
    )


@query()
def op4_license_scan(t: Source) -> DataFrame:
    return licenses.license_report(licenses.license_matches(t.documents)).withColumnRenamed("id", "doc_id")


@query()
def op5_pivot_dedup(t: Source) -> DataFrame:
    return pivots.near_vectors(t.embeddings).withColumnRenamed("id", "vec_id")


@query(r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) as size from documents),
quality as (
  select doc_id, 1 + avg(quality) as weight from labels where doc_id is not null and quality is not null group by doc_id),
keyed as (
  select s.*, -ln((('0x' || substr(md5('mix:' || coalesce(s.doc_id::varchar, '')), 1, 13))::bigint + 1) / 4503599627370496.0::double)
              / coalesce(q.weight, 1.5) as key
  from sized s left join quality q using (doc_id)),
sources as (
  select source, sum(size)::bigint as source_size,
         [5, 2, 1][((row_number() over (order by source is null, encode(source)) - 1) % 3 + 1)::int] as weight
  from sized group by source),
ordered as (
  select *, 2 * source_size as cap, sum(source_size) over () * 1.5::double as total,
         coalesce(sum(2 * source_size) over earlier, 0) as caps_before, coalesce(sum(weight) over earlier, 0) as weight_before,
         sum(weight) over () as weights
  from sources window earlier as (order by 2 * source_size / weight, source is null, encode(source)
                                  rows between unbounded preceding and 1 preceding)),
filled as (select *, (total - caps_before) * weight >= cap * (weights - weight_before) as is_full from ordered),
goals as (
  select source, source_size,
         case when is_full then cap::double
              else weight * (total - coalesce(sum(cap) filter (is_full) over (), 0)::double)
                   / sum(weight) filter (not is_full) over () end as target
  from filled),
goal as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as epochs from goals),
placed as (
  select k.*, g.source_size, g.target, g.epochs, g.target - g.epochs * g.source_size as rest,
         sum(k.size) over (partition by k.source order by k.key, k.doc_id, k.size
                           rows between unbounded preceding and current row) - k.size / 2 as middle
  from keyed k join goal g on k.source is not distinct from g.source)
select doc_id, size::bigint as size, source_size, target,
       (size * (epochs + case when middle <= rest then 1 else 0 end))::bigint as taken
from placed
""")
def op6_source_mix(t: Source) -> DataFrame:
    decided = mixing.mixed(t.documents, mixing.label_weights(t.labels))
    return decided.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


@query()
def op7_token_files(t: Source) -> DataFrame:
    path = scratch_path(t.spark, "token-files")
    idfiles.write_ids(t.documents, path)
    return idfiles.read_ids(t.spark, path).select(
        F.col("id").alias("doc_id"), "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op8_warc_archives(t: Source) -> DataFrame:
    path = scratch_path(t.spark, "archives")
    warc.write_archives(t.pages, path)
    return warc.read_archives(t.spark, path, with_payload=False).drop("url").withColumnRenamed("id", "page_id")


@query(r"""
with texts as (
  select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
  from documents)
select doc_id, min(doc_id) over g as keep_id, count(*) over g as group_size,
       doc_id = min(doc_id) over g as kept, text_sha256
from texts window g as (partition by text_sha256)
""")
def op9_exact_dedup(t: Source) -> DataFrame:
    return exact.exact_groups(t.documents).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept",
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


@query()
def op10_minhash_dedup(t: Source) -> DataFrame:
    return minhash.near_duplicates(t.documents, width=2).drop("text_hash").withColumnRenamed("id", "doc_id")


@query(r"""
with texts as (
  select coalesce(lang, 'und') as lang,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as text
  from documents),
pieces as (select lang, unnest(regexp_split_to_array(text, '[.,;:!?\x0A-\x0D]')) as piece from texts),
spoken as (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as words from pieces),
grams as (
  select lang, k, unnest(list_transform(range(1, len(words) - k + 2), lambda i: array_to_string(words[i:i + k - 1], ' '))) as phrase
  from spoken, (select unnest([1, 2, 3]) as k)),
counts as (select lang, k, phrase, count(*) as n from grams group by all),
languages as (select lang, sum(n)::bigint as n from counts where k = 1 group by lang),
f as (select * from counts where n >= 10),
cut as (
  select lang, k, phrase, n as a, c, array_to_string(string_split(phrase, ' ')[1:c], ' ') as head,
         array_to_string(string_split(phrase, ' ')[c + 1:k], ' ') as tail
  from (select *, unnest(range(1, k)) as c from f where k > 1)),
scored as (
  select cut.lang, cut.k, cut.phrase, a, h.n as l, t.n as r, c,
         ((1000000::hugeint * a * a) // (h.n::hugeint * t.n))::bigint as score
  from cut join f h on h.lang = cut.lang and h.phrase = head join f t on t.lang = cut.lang and t.phrase = tail),
lowest as (select * from scored qualify row_number() over (partition by lang, phrase order by score, c) = 1),
inside as (
  select lang, unnest([array_to_string(string_split(phrase, ' ')[1:2], ' '), array_to_string(string_split(phrase, ' ')[2:3], ' ')]) as phrase, n
  from f where k = 3),
around as (select lang, phrase, max(n) as n from inside group by all),
kept as (
  select lowest.* from lowest left join around on around.lang = lowest.lang and around.phrase = lowest.phrase
  where around.n is null or 100 * around.n < 50 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, encode(phrase)) as rank, phrase, a, l, r, languages.n, score
from kept join languages using (lang)
qualify rank <= 2000
""")
def op11_collocations(t: Source) -> DataFrame:
    return collocations.collocations(t.documents)


@query()
def op12_passage_dedup(t: Source) -> DataFrame:
    return passages.repeated_passages(t.documents).drop("removed", "kept").withColumnRenamed("id", "doc_id")


@query()
def op13_whitening(t: Source) -> DataFrame:
    return whitening.whitened(t.embeddings).withColumn("deviation", F.col("deviation").cast("long")).withColumnRenamed("id", "vec_id")
