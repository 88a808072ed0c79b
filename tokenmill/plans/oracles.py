"""DuckDB SQL for the registered queries, over the same tables."""

from __future__ import annotations

# Byte ids of each document, its position, and of each chunk of 100 with the
# delimiter 256 in front.
_DOCS = """
docs as (
  select doc_id, text, lang, row_number() over (order by doc_id) - 1 as ord,
         list_transform(regexp_extract_all(hex(encode(text)), '..'),
                        lambda h: ('0x' || h)::int) as ids
  from documents
)
"""

# Every token of the packed corpus with its global offset, shard and place.
_TOKENS = f"""
with {_DOCS},
marked as (
  select ord, case when ord % 100 = 0 then list_concat([256], ids) else ids end as ids from docs
),
placed as (
  select ids, coalesce(sum(len(ids)) over (
           order by ord rows between unbounded preceding and 1 preceding), 0)::bigint as first_g
  from marked
),
flat as (
  select first_g + unnest(range(len(ids))) as g, unnest(ids) as token from placed
),
total as (select (max(g) + 1)::bigint as t from flat),
tokens as (
  select g // 100000 as shard_id, g % 100000 as pos, token,
         least(100000, t - (g // 100000) * 100000) as shard_tokens,
         case when t - (g // 100000) * 100000 >= 100000 then 'train_set' else 'val_set' end as split
  from flat, total
)
"""

_CHECKSUMS = """
select split, shard_id, count(*)::bigint as n_tokens, sum(token)::bigint as id_sum,
       sum(token * (pos % 1000))::bigint as place_sum
from tokens group by split, shard_id
"""

_MANIFEST = """
with o as (select row_number() over (order by doc_id) - 1 as ord,
                  octet_length(encode(text)) as nb from documents),
c as (select ord // 100 as chunk_id, sum(nb) + 1 as n from o group by 1),
total as (select sum(n)::bigint as t from c),
manifest as (
  select s as shard_id, least(100000, t - s * 100000)::bigint as n_tokens,
         case when t - s * 100000 >= 100000 then 'train_set' else 'val_set' end as split
  from (select t, unnest(range((t + 99999) // 100000)) as s from total)
)
"""

_WINDOWS = """,
paired as (
  select split, shard_id, shard_tokens, pos // 32 as w, pos, token,
         lead(token) over (partition by shard_id order by pos) as y from tokens
),
windows as (
  select split, shard_id, shard_tokens, w as "window",
         string_agg(token::varchar, ' ' order by pos) as x,
         string_agg(y::varchar, ' ' order by pos) as y,
         min(y) filter (pos % 32 = 31) as y_last
  from paired group by all having count(y) = 32
)
"""

# Batches per rank and shard, and the first batch number of each in a cycle.
_SCHEDULE = """,
ranks as (select unnest(range(4)) as rank),
taken as (
  select shard_id, rank,
         case when n_tokens >= 128 * (rank + 1) + 1
              then greatest(1, (n_tokens - 1 - 128 * rank) // 512) else 0 end as n_b
  from manifest, ranks where split = '{split}'
),
spans as (
  select *, sum(n_b) over (partition by rank order by shard_id) - n_b as lo,
         sum(n_b) over (partition by rank order by shard_id) as hi,
         sum(n_b) over (partition by rank) as cycle
  from taken
),
wanted as (select unnest(range({n})) as i {wanted_from}),
schedule as (
  select s.rank::int as rank, i::bigint as i, shard_id::bigint as shard_id,
         (128 * (s.rank + (i % cycle - lo) * 4))::bigint as pos
  from wanted join spans s on i % cycle >= lo and i % cycle < hi
)
"""

_SOFTMAX = """
with long as (
  select vec_id as pos, generate_subscripts(embedding, 1) - 1 as id,
         unnest(embedding)::double as score from embeddings
),
tops as (select pos, max(score) as top from long group by pos),
probs as (
  select pos, id, exp(score - top) / sum(exp(score - top)) over (partition by pos) as p
  from long join tops using (pos)
),
ranked as (
  select *, row_number() over (partition by pos order by p desc, id) as rank_no from probs
),
best as (select * from ranked where rank_no <= 50)
"""

_SOFTMAX_OUT = "select pos, id::int as id, round(p, 9) as prob from probs"
_TOPK_OUT = "select pos, rank_no::int as rank_no, id::int as id, round(p, 9) as prob from best"
_DRAW_OUT = """,
cum as (
  select pos, id, rank_no, sum(p) over (partition by pos order by rank_no) as seen,
         sum(p) over (partition by pos) as whole,
         ('0x' || substr(md5('42:' || pos), 1, 13))::bigint / 4503599627370496.0::double as u
  from best
)
select pos, arg_min(id, rank_no)::int as id from cum
where seen > u * whole or rank_no = 50 group by pos
"""

_SERIES = """
series as (select user_id as run_id, event_id as step, value as loss from events)
"""

_STEP_MEANS = """
by_rank as (
  select user_id as run_id, event_id // 1000 as step, event_id % 4 as rank, avg(value) as loss
  from events group by all
),
series as (select run_id, step, round(avg(loss), 6) as loss from by_rank group by run_id, step)
"""

_FOLD_OVER = """
with recursive {series},
s as (
  select run_id, step, loss, -loss as score,
         row_number() over (partition by run_id order by step) as n from series
),
f as (
  select run_id, step, loss, n, score as best, step as best_step, 0::bigint as counter,
         true as improved, false as stopped from s where n = 1
  union all
  select s.run_id, s.step, s.loss, s.n,
         case when s.score < f.best + 0.2::double then f.best else s.score end,
         case when s.score < f.best + 0.2::double then f.best_step else s.step end,
         case when s.score < f.best + 0.2::double then f.counter + 1 else 0 end,
         not (s.score < f.best + 0.2::double),
         f.stopped or (s.score < f.best + 0.2::double and f.counter + 1 >= 30)
  from f join s on s.run_id = f.run_id and s.n = f.n + 1
)
"""

_FOLD = _FOLD_OVER.format(series=_SERIES)

_LAST_STATE = """
select run_id, n as n_steps, best_step, best as score, -best as val_loss, counter, stopped
from f qualify row_number() over (partition by run_id order by n desc) = 1
"""

_FOLD_END = _FOLD + _LAST_STATE

_LR = """case when {s} < 715 then 6e-4::double * ({s} + 1) / 715
     when {s} > 19073 then 6e-4::double * 0.1
     else 6e-4::double * 0.1 + 0.5 * (1 + cos(pi() * ({s} - 715) / (19073 - 715)::double))
          * (6e-4::double - 6e-4::double * 0.1) end"""

_RUN_LOG = f"""
select event_id as step, value as loss, round(value / 2, 3) as norm,
       printf('%.4e', {_LR.format(s='event_id')})::double as lr, round(value * 10 + 100, 1) as dt_ms,
       524288::bigint as tokens_processed
from events where event_id % 7 <> 3
"""

# The merged pairs cannot overlap, so their tokens can be counted in the joined text.
_BPE_COUNTS = """
with {docs}, sized as (select *, count(*) over () as n from docs),
c as (select {group} as part, string_agg(text, '' order by ord) as text,
             sum(list_sum(ids)) as byte_sum from sized group by 1),
k as (select *, octet_length(encode(text)) as nb,
             (length(text) - length(replace(text, 'an', ''))) // 2 as n_an,
             (length(text) - length(replace(text, 'in', ''))) // 2 as n_in,
             (length(text) - length(replace(text, 'on', ''))) // 2 as n_on,
             (length(text) - length(replace(text, 'en', ''))) // 2 as n_en,
             (length(text) - length(replace(text, 'ion', ''))) // 3 as n_ion from c),
counted as (
  select part, (1 + nb - n_an - n_in - n_on - n_en - n_ion)::bigint as n_tokens,
         (261 + byte_sum + n_an * (256 - 97 - 110) + n_in * (257 - 105 - 110)
          + n_on * (258 - 111 - 110) + n_en * (259 - 101 - 110)
          + n_ion * (260 - 105 - 258))::bigint as id_sum
  from k
)
"""

SQL: dict[str, str] = {
    "corpus_totals": """
select count(*) as n_rows, sum(length(text))::bigint as n_chars from documents
""",
    "corpus_by_lang": """
select lang, source, count(*) as n_rows, sum(length(text))::bigint as n_chars
from documents group by lang, source
""",
    "registry_french": "select doc_id, text from documents where lang = 'fr'",
    "boundary_template": """
select conv_id, turn, '<|startoftext|> ' || text || ' <|endoftext|>' as text from conversations
""",
    "chunk_stats": """
with o as (select row_number() over (order by doc_id) - 1 as ord, text from documents)
select ord // 100 as chunk_id, count(*)::int as n_rows,
       (sum(octet_length(encode(text))) + 1)::bigint as n_tokens
from o group by 1
""",
    "chunk_text_digest": """
with o as (select row_number() over (order by conv_id, turn) - 1 as ord, text from conversations)
select ord // 20 as chunk_id, count(*)::int as n_rows,
       md5(string_agg(text, '' order by ord)) as digest
from o group by 1
""",
    "first_chunks": """
with o as (select doc_id, row_number() over (order by doc_id) - 1 as ord from documents)
select doc_id, ord, ord // 100 as chunk_id from o
where ord // 100 < (select count(*) // 100 // 2 from documents)
""",
    "split_by_position": """
with o as (select doc_id, row_number() over (order by doc_id) - 1 as ord,
                  count(*) over () as n from documents)
select doc_id, case when ord < floor(0.8::double * n) then 'train_set'
                    when ord < floor(0.8::double * n) + floor(0.15::double * n) then 'val_set'
                    else 'test_set' end as split from o
""",
    "tokens_per_split": """
with o as (select octet_length(encode(text)) as nb, row_number() over (order by doc_id) - 1 as ord,
                  count(*) over () as n from documents)
select case when ord < floor(0.8::double * n) then 'train_set'
            when ord < floor(0.8::double * n) + floor(0.15::double * n) then 'val_set'
            else 'test_set' end as split, (sum(nb) + 1)::bigint as n_tokens
from o group by 1
""",
    "text_files": """
select sum(length(text) - length(replace(text, chr(10), '')) + 1)::bigint as n_lines,
       sum(length(replace(text, chr(10), '')))::bigint as n_chars from documents
""",
    "whole_text_files": """
select (2 * sum(length(text) + 1))::bigint as n_chars,
       (2 * sum(length(text) - length(replace(text, chr(10), '')) + 1))::bigint as n_feeds,
       true as all_end from documents
""",
    "chat_tokens_per_split": """
with o as (select conv_id, list_transform(regexp_extract_all(hex(encode(text)), '..'),
                                          lambda h: ('0x' || h)::int) as ids,
                  row_number() over (order by conv_id, turn) - 1 as ord,
                  count(*) over () as n from conversations)
select case when ord < floor(0.8::double * n) then 'train_set'
            when ord < floor(0.8::double * n) + floor(0.15::double * n) then 'val_set'
            else 'test_set' end as split, min(conv_id) as conv_id, count(*) as n_rows,
       (sum(len(ids)) + 1)::bigint as n_tokens, (sum(list_sum(ids)) + 256)::bigint as id_sum
from o group by 1
""",
    "split_without_documents": """
with o as (select octet_length(encode(r_name)) as nb,
                  row_number() over (order by r_regionkey) - 1 as ord,
                  count(*) over () as n from region),
s as (select case when ord < floor(0.8::double * n) then 'train_set'
                  when ord < floor(0.8::double * n) + floor(0.15::double * n) then 'val_set'
                  else 'test_set' end as split, nb from o)
select name as split, (coalesce(sum(nb), 0) + 1)::bigint as n_tokens
from (values ('train_set'), ('val_set'), ('test_set')) v(name) left join s on split = name
group by name
""",
    "byte_token_checksum": f"""
with {_DOCS}, t as (select ord, list_concat([256], ids) as ids from docs)
select ord as doc_no, len(ids)::bigint as n_tokens, list_sum(ids)::bigint as id_sum,
       list_sum(list_transform(ids, lambda x, i: x * ((i - 1) % 1000)))::bigint as place_sum
from t
""",
    "token_range_report": """
select lang, sum(octet_length(encode(text)))::bigint as n_tokens, 0::bigint as n_out_of_range,
       sum(length(regexp_replace(text, '[^\\x00-\\x7F]', '', 'g')))::bigint as n_known
from documents group by lang
""",
    "truncated_tokens": f"""
with {_DOCS}
select doc_id, len(ids[1:50])::int as n_tokens,
       coalesce(list_sum(ids[1:50]), 0)::bigint as id_sum from docs
""",
    "bpe_chunk_checksum": _BPE_COUNTS.format(docs=_DOCS, group="ord // 100")
    + "select part as chunk_id, n_tokens, id_sum from counted",
    "bpe_tokens_per_split": _BPE_COUNTS.format(
        docs=_DOCS,
        group="""case when ord < floor(0.8::double * n) then 'train_set'
                      when ord < floor(0.8::double * n) + floor(0.15::double * n) then 'val_set'
                      else 'test_set' end""",
    )
    + "select part as split, n_tokens, id_sum from counted",
    "bpe_round_trip": "select doc_id, text from documents",
    "shard_manifest": _MANIFEST + """
select split, shard_id, n_tokens, split || '_shard_' || lpad(shard_id::varchar, 6, '0') as name
from manifest
""",
    "shard_checksum": _TOKENS + _CHECKSUMS,
    "shard_limit": _MANIFEST + "select split, shard_id, n_tokens from manifest where shard_id < 5",
    "pack_progress": _MANIFEST + """
select sum(n_tokens)::bigint as n_tokens, count(*) as n_shards,
       sum(case when split = 'val_set' then n_tokens else 0 end)::bigint as open_tokens
from manifest
""",
    "shard_listing": _MANIFEST + """
select shard_id, n_tokens from manifest where split = 'train_set'
""",
    "shard_read": _TOKENS + """
select shard_id, count(*)::bigint as n_tokens, sum(token)::bigint as id_sum,
       sum(token * (pos % 1000))::bigint as place_sum
from tokens where split = 'train_set' and shard_id = 0 group by shard_id
""",
    "split_shard_counts": _MANIFEST + """
select split, count(*) as n_shards, sum(n_tokens)::bigint as n_tokens from manifest group by split
""",
    "npy_round_trip": _TOKENS + _CHECKSUMS,
    "window_pairs": _TOKENS + _WINDOWS + """
select split, shard_id, "window", x, y from windows
""",
    "rank_batch_rows": _TOKENS + _WINDOWS + """
select split, shard_id, "window", (("window" // 4) % 4)::bigint as rank,
       "window" // 16 as batch, ("window" % 4)::int as row, x, y
from windows
where shard_tokens >= 128 * (("window" // 4) % 4 + 1) + 1
  and "window" // 16 < greatest(1, (shard_tokens - 1 - 128 * (("window" // 4) % 4)) // 512)
""",
    "rank_schedule": _MANIFEST
    + _SCHEDULE.format(split="train_set", n="2 * (t // 512)", wanted_from="from total")
    + "select *, i // 8 as step, (i % 8)::int as micro from schedule",
    "eval_schedule": _MANIFEST
    + _SCHEDULE.format(split="val_set", n="20", wanted_from="")
    + "select * from schedule",
    "training_plan": _MANIFEST + f""",
steps as (select unnest(range(t // 128)) as step, t // 128 as n from total),
due as (select *, (step % 20 = 0 and step <> 0) or step = n - 1 as v from steps)
select step, ((step + 1) * 128)::bigint as tokens, round({_LR.format(s='step')}, 12) as lr,
       v as validate, v as sample,
       v and step > 0 and (step % 2 = 0 or step = n - 1) as monitor, step = n - 1 as last
from due
""",
    "prompt_window": _TOKENS + """,
w as (select pos // 7 as "window", string_agg(token::varchar, ' ' order by pos) as ids
      from tokens where shard_id = 0 and pos < 35 group by 1)
select "window", ids from w order by md5('42:' || "window") limit 1
""",
    "prompt_as_text": _TOKENS + """,
w as (select pos // 7 as "window",
             string_agg(case when token = 256 then '<|endoftext|>' else chr(token) end, ''
                        order by pos) as text
      from tokens where shard_id = 0 and pos < 35 group by 1)
select "window", text from w order by md5('42:' || "window") limit 1
""",
    "cross_entropy_by_label": """
with long as (
  select vec_id, label, unnest(embedding)::double as score,
         embedding[label + 1]::double as target from embeddings
),
lse as (select vec_id, label, any_value(target) as target, ln(sum(exp(score))) as lse
        from long group by vec_id, label)
select label, round(avg(lse - target), 9) as loss, count(*) as n_positions from lse group by label
""",
    "grouped_softmax": _SOFTMAX + _SOFTMAX_OUT,
    "softmax_rows": _SOFTMAX + _SOFTMAX_OUT,
    "topk_scores": _SOFTMAX + _TOPK_OUT,
    "topk_rows": _SOFTMAX + _TOPK_OUT,
    "weighted_draw": _SOFTMAX + _DRAW_OUT,
    "weighted_draw_rows": _SOFTMAX + _DRAW_OUT,
    "last_position": """
select user_id as run_id, event_id as step, value as loss from events
qualify row_number() over (partition by user_id order by event_id desc) = 1
""",
    "loss_by_step": """
with r as (select event_id // 64 as step, event_id % 4 as rank, avg(value) as loss
           from events group by 1, 2)
select step, round(avg(loss), 9) as loss, count(*) as n_ranks from r group by step
""",
    "throughput": """
select user_id as run_id, (count(*) * 128)::bigint as tokens,
       round(sum(value * 10 + 100) / 1000.0, 6) as seconds,
       round(count(*) * 128 / (sum(value * 10 + 100) / 1000.0), 6) as tokens_per_second,
       round(epoch_us(max(ts)) / 1e6 - epoch_us(min(ts)) / 1e6, 6) as wall_seconds
from events group by user_id
""",
    "run_log_parse": _RUN_LOG,
    "run_log_malformed": """
select '? ' || event_type as line, count(*) as n_lines from events
where event_id % 7 = 3 group by event_type
""",
    "validation_log": "select event_id as step, round(value, 4) as val_loss from events",
    "monitored_steps": """
with n as (select max(event_id) as last from events)
select user_id as run_id, event_id as step, value as loss from events, n
where ((event_id % 20 = 0 and event_id <> 0) or event_id = last)
  and event_id > 0 and (event_id % 30 = 0 or event_id = last)
""",
    "early_stop_state": _FOLD_END,
    "early_stop_steps": _FOLD + """
select run_id, step, loss, best, counter, improved, stopped from f
""",
    "improvement_events": _FOLD + """
select run_id, step, best as score, loss as val_loss from f where improved
""",
    "validation_pipeline": _FOLD_OVER.format(series=_STEP_MEANS) + _LAST_STATE,
    "stream_pack": _TOKENS + _CHECKSUMS,
    "stream_pack_bounded": _TOKENS.replace(
        "as ids from docs\n", "as ids from docs\n  where ord < (select count(*) // 200 * 100 from docs)\n"
    )
    + _CHECKSUMS,
    "stream_progress": """
with o as (select row_number() over (order by doc_id) - 1 as ord, count(*) over () as n,
                  octet_length(encode(text)) as nb from documents),
b as (select unnest(range(-1, 3)) as batch),
upto as (select batch, any_value(n) * (batch + 1) // 3 as seen,
                (coalesce(sum(nb) filter (ord < n * (batch + 1) // 3 // 100 * 100), 0)
                 + any_value(n) * (batch + 1) // 3 // 100)::bigint as tokens
         from b, o group by batch)
select x.batch::bigint as batch, (x.seen - y.seen)::bigint as n_rows, x.tokens - y.tokens as n_tokens,
       x.tokens // 100000 as full_shards, x.tokens % 100000 as open_tokens
from upto x join upto y on y.batch = x.batch - 1
""",
    "stream_early_stop": _FOLD_END,
    "stream_run_state": _FOLD_END,
    "stream_run_log": _RUN_LOG,
}
