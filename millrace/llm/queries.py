"""One query per operator over its whole tables, with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm import (alignment, chat_format, containment, host_quality, near_dedup, packing, prefix_trie, repeats, segment_sampling, sharding, token_counts, token_files,
                          url_filter)
from millrace.llm.registry import CHECKS, QUERIES, query  # noqa: F401



def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file; it is installed on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


# Words of a text, as in texts.BLANKS.
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"
FOLDED = f"translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query("op1_near_dedup", sql=rf"""
with recursive w as (select doc_id, regexp_extract_all({FOLDED}, '[^\x20\x09-\x0D]+') ws from documents),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) <= 4 then [array_to_string(ws, ' ')]
        else [ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] || ' ' || ws[i + 3] for i in range(1, len(ws) - 2)] end) g from w),
n as (select doc_id, count(*) n from s group by 1),
rare as (select g from s group by g having count(*) > 1),
t as (select s.* from s join rare using (g)),
p as (select a.doc_id a, b.doc_id b, count(*) c from t a join t b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
e as (select p.a, p.b from p join n x on x.doc_id = p.a join n y on y.doc_id = p.b where 100 * c >= 80 * (x.n + y.n - c)),
both_ways as (select a, b from e union all select b, a from e),
r(v, c) as (select doc_id, doc_id from documents union select both_ways.b, r.c from r join both_ways on r.v = both_ways.a where r.c < both_ways.b),
m as (select v doc_id, min(c) component_id from r group by 1)
select w.doc_id, coalesce(n.n, 0)::bigint n_shingles, m.component_id, w.doc_id = m.component_id kept from w left join n using (doc_id) join m using (doc_id)
""")
def op1(read) -> DataFrame:
    return near_dedup.near_duplicates(read("documents"), shingle_words=4).select("doc_id", "n_shingles", "component_id", "kept")


MEASURES = rf"""
w as (select doc_id, source host, {WORDS} ws, coalesce(text, '') text from documents),
g as (select doc_id, unnest(range(1, len(ws) - 1)) i, unnest([[ws[i], ws[i + 1], ws[i + 2]] for i in range(1, len(ws) - 1)]) g from w),
d as (select doc_id, i, count(*) over (partition by doc_id, g) c from g),
k as (select doc_id, count(distinct j) n_repeat_words from (select doc_id, unnest([i, i + 1, i + 2]) j from d where c > 1) group by 1),
l as (select doc_id, count(*) n_lines, count(*) - count(distinct line) n_dup_lines
      from (select doc_id, unnest(string_split(text, chr(10))) line from w) where regexp_matches(line, '[^\x20\x09-\x0D]') group by 1),
f as (select w.doc_id, host, len(ws)::bigint n_words, length(array_to_string(ws, ''))::bigint word_chars, length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint n_symbols,
             coalesce(n_lines, 0)::bigint n_lines, coalesce(n_dup_lines, 0)::bigint n_dup_lines, coalesce(n_repeat_words, 0)::bigint n_repeat_words
      from w left join k using (doc_id) left join l using (doc_id)),
m as (select *, n_words < 50 or 100 * n_repeat_words > 50 * n_words base_failed from f)"""

HOSTS = "".join(f"""
, h_{k} as (select host, count(*)::double n, count_if({r})::double f from m where host is not null group by host)
, t_{k} as (select count(*) - 1 free, sum(n) docs, sum(n * n) squares, sum(f) / sum(n) mean, sum(f * f / n) q from h_{k})
, r_{k} as (select *, (q - docs * mean * mean - free * mean * (1 - mean)) / nullif(mean * (1 - mean) * (docs - squares / docs - free), 0) r from t_{k})
, b_{k} as (select host from h_{k}, r_{k} where case when coalesce(r, 0) <= 0 or docs - squares / docs - free <= 0 then mean
                else (f + (1 - least(r, 1)) / least(r, 1) * mean) / (n + (1 - least(r, 1)) / least(r, 1)) end > 0.5)""" for k, r in host_quality.RULES.items())

JUDGED = f"with {MEASURES.strip()}{HOSTS}\n, bad as ({' union '.join(f'select host from b_{k}' for k in host_quality.RULES)})"


@query("op2_host_quality", sql=f"""{JUDGED}
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, not base_failed and (host is null or host not in (select host from bad)) kept from m""")
def op2(read) -> DataFrame:
    return host_quality.judge(read("documents")).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


_HITS = "|".join("".join("\\" + c if c in "[]|\\" else c for c in control) for control in chat_format.CONTROLS)
_LENGTH = f"""length(regexp_replace(replace({{0}}, '\\', '\\\\'), '{_HITS}', '..', 'g'))"""


@query("op5_chat_format", sql=f"""
with c as (select conv_id, turn, coalesce(role, '') as r, coalesce(text, '') as t from conversations
           union all select -7, 0, 'user', '</s>[INST] ok [/INST]' union all select -7, 1, 'assistant', '</s>[INST] ok [/INST]')
select conv_id, count(*) as n_turns, sha256(string_agg(r || chr(10) || t || chr(10), '' order by turn, r, t)) as turns_sha256,
       sum(case when r = 'assistant' then length(t) else 0 end)::bigint as loss_chars,
       sha256(coalesce(string_agg(case when r = 'assistant' then t else '' end, '' order by turn, r, t), '')) as loss_sha256,
       sum({len("<|im_start|><|im_sep|><|im_end|>") + 1} + {_LENGTH.format("r")} + {_LENGTH.format("t")})::bigint as formatted_chars
from c group by conv_id""")
def op5(read) -> DataFrame:
    turns = read("conversations").select("conv_id", "turn", "role", "text")
    said = "</s>[INST] ok [/INST]"
    probe = turns.sparkSession.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], turns.schema)
    return chat_format.digests(chat_format.format_conversations(turns.unionByName(probe)))


@query("op6_url_filter")
def op6(read) -> DataFrame:
    return url_filter.filter_urls(read("pages"))


@query("op7_containment", sql=rf"""
with w as (select doc_id, regexp_extract_all({FOLDED}, '[^\x20\x09-\x0D]+') ws from documents),
v as (select item_id, regexp_extract_all({FOLDED}, '[^\x20\x09-\x0D]+') ws from benchmark),
s as (select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) <= 5 then [array_to_string(ws, ' ')]
        else [array_to_string(ws[i : i + 4], ' ') for i in range(1, len(ws) - 3)] end) g from w),
b as (select distinct item_id, unnest(case when len(ws) = 0 then [] when len(ws) <= 5 then [array_to_string(ws, ' ')]
        else [array_to_string(ws[i : i + 4], ' ') for i in range(1, len(ws) - 3)] end) g from v),
q as (select item_id, count(*) n from b group by 1),
h as (select doc_id, item_id, count(*) c from s join b using (g) group by 1, 2),
f as (select doc_id, item_id, c / n as share from h join q using (item_id) where 100 * c >= 80 * n)
select doc_id, count(item_id) n_items, coalesce(string_agg(item_id::varchar, ',' order by item_id), '') item_ids,
       coalesce(max(share), 0.0)::double containment, count(item_id) > 0 contaminated
from (select distinct doc_id from documents) left join f using (doc_id) group by 1""")
def op7(read) -> DataFrame:
    found = containment.contamination(read("documents"), read("benchmark"))
    return found.withColumn("item_ids", F.array_join("item_ids", ","))


@query("op8_token_counts")
def op8(read) -> DataFrame:
    return token_counts.section_tokens(read("documents"), tokenizer_path("byte_bpe_50k.json"), rule="most")


@query("op9_token_files")
def op9(read) -> DataFrame:
    return token_files.token_file_digest(read("documents"), tokenizer_path("byte_bpe_50k.json"))


@query("op3_sharding")
def op3(read) -> DataFrame:
    return sharding.shard_documents(read("documents"), shards=24)


def sampled_digest(docs: DataFrame) -> DataFrame:
    """One row per sampled segmentation: its size and checksum, scores, and whether it decodes to the text."""
    samples = segment_sampling.sample_segmentations(docs, tokenizer_path("piece_bpe_32k.model"), k=3)
    return samples.select("doc_id", "rank", (F.octet_length("ids") / 4).cast("bigint").alias("n_pieces"), F.crc32("ids").alias("ids_crc32"), "log_prob", "score", "inclusion", "exact")


@query("op10_segment_sampling")
def op10(read) -> DataFrame:
    return sampled_digest(read("documents"))


@query("op4_repeats")
def op4(read) -> DataFrame:
    found = repeats.repeated_spans(read("documents"), span=50)
    removed = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op11_packing")
def op11(read) -> DataFrame:
    pieces = packing.pack_documents(read("documents"), tokenizer_path("byte_bpe_50k.json"), capacity=1024)
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset", "sequence_tokens", "sequence_cost")


# CRC-32 of a decimal number, bit by bit.
CRC = """xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(1, length(conv_id::varchar) + 1), lambda i: ascii((conv_id::varchar)[i])::bigint)),
         lambda c, x: list_reduce(list_prepend(xor(c, x), range(8)), lambda v, k: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295)"""


@query("op12_prefix_trie", sql=rf"""
with own as (select conv_id, coalesce(role, '') r, coalesce(text, '') t, row_number() over (partition by conv_id order by turn nulls first, coalesce(role, ''), coalesce(text, '')) place
             from conversations where conv_id is not null),
h as (select conv_id, conv_id - conv_id % 20 base, {CRC} % 4 h from (select distinct conv_id from own)),
b as (select h.conv_id, o.place d, o.r, o.t from h join own o on o.conv_id = h.base and o.place <= h.h
      union all select h.conv_id, 4 + o.place, o.r, o.t from h join own o on o.conv_id = h.conv_id and o.place > h.h),
s as (select h.conv_id, coalesce(list(struct_pack(r := r, t := t) order by d) filter (d is not null), []) ts from h left join b using (conv_id) group by 1),
p as (select conv_id, ts, unnest(range(0, len(ts) + 1)) d from s),
n as (select d, ts[1 : d] key, min(conv_id) conv_id, count(*) n, coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (len(ts) = d), '') ends from p group by 1, 2),
c as (select d - 1 d, key[1 : d - 1] key, count(*) children from n where d > 0 group by 1, 2),
f as (select n.*, coalesce(children, 0) children, case when d = 0 then 0 else (n - 1) * len(regexp_extract_all(key[d].t, '[^ 	-]+')) end saved from n left join c using (d, key)),
u as (select f.key[1 : e] key, e d, count_if(children = 0) leaves, sum(saved) saved from (select *, unnest(range(0, d + 1)) e from f) f group by 1, 2)
select f.conv_id, f.d::bigint as depth, o.conv_id parent_conv_id, f.n n_convs, f.children::bigint n_children, leaves::bigint n_leaves, u.saved::bigint saved_tokens, sha256(f.ends) ends_sha256
from f join u using (d, key) left join n o on o.d = f.d - 1 and o.key = f.key[1 : f.d - 1]
""")
def op12(read) -> DataFrame:
    return prefix_trie.prefix_trie(read("conversations")).drop("leader")


@query("op13_alignment")
def op13(read) -> DataFrame:
    found, _ = alignment.align(read("documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))
    return found.select("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
