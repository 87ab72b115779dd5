"""Registered queries of this folder, with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import bpe, decontaminate, exact_dedup, fim, html_text, jaccard, lattice, lines, manifest, mixing, secrets, suffix_dedup, toxicity
from .common import read_table


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.dedup(read_table(spark, folder, "documents"))


def op2_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return html_text.extract(read_table(spark, folder, "pages"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.severity(read_table(spark, folder, "documents"), read_table(spark, folder, "labels"))


def op4_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan(read_table(spark, folder, "documents"))


def op5_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lines.report(read_table(spark, folder, "documents"))


def op6_lattice_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.dedup(read_table(spark, folder, "embeddings"))


def op7_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard.groups(read_table(spark, folder, "documents"))


def op8_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.dedup(spark, f"{folder}/documents.parquet")


def op9_source_mixing(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix(read_table(spark, folder, "documents"))


def source_mixing_copies(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.copies(read_table(spark, folder, "documents"))


def op10_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.digests(read_table(spark, folder, "documents"), tokenizer_file())


def op11_fim(spark: SparkSession, folder: str) -> DataFrame:
    return fim.digests(read_table(spark, folder, "documents"))


def op12_merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    return manifest.audit(read_table(spark, folder, "documents"))


def op13_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.report(read_table(spark, folder, "documents"), read_table(spark, folder, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_suffix_dedup, op2_html_text, op3_toxicity, op4_secret_scan, op5_line_dedup, op6_lattice_dedup, op7_jaccard_join, op8_exact_dedup, op9_source_mixing, source_mixing_copies, op10_bpe, op11_fim, op12_merkle_manifest, op13_decontaminate)
}


def _mixing_sql() -> str:
    """Raking spelled out: one step per round and margin."""
    margins = ("source", "lang", "topic")
    steps = [
        """with d as (
      select doc_id, source, lang, coalesce(text, '') as body,
        case when contains(coalesce(text, ''), 'License') then 'legal' when contains(coalesce(text, ''), ' | ') then 'table'
             when contains(coalesce(text, ''), '!!') or contains(coalesce(text, ''), '%%%') or contains(coalesce(text, ''), '###') then 'noise'
             else 'prose' end as topic
      from documents),
    t as (select doc_id, source, lang, topic, len(regexp_extract_all(body, '[^\\x20\\x09-\\x0D]+'))::bigint as n from d),
    c as (select source, lang, topic, sum(n)::double as tokens from t group by all),
    w0 as (select *, tokens as w from c)"""
    ]
    for m in margins:
        steps.append(
            f"g_{m} as (select {m}, pow(sum(tokens), 0.7) as s from c group by 1), "
            f"t_{m} as (select {m}, s * (select sum(tokens) from c) / (select sum(s) from g_{m}) as target from g_{m})"
        )
    k = 0
    for _ in range(12):
        for m in margins:
            steps.append(
                f"w{k + 1} as (select w.source, w.lang, w.topic, w.tokens, w.w * t.target / sum(w.w) over (partition by w.{m}) as w "
                f"from w{k} w join t_{m} t on w.{m} is not distinct from t.{m})"
            )
            k += 1
    last = f"""f as (select source, lang, topic, case when tokens > 0 then w / tokens else 0.0 end as factor from w{k}),
    u as (select t.*, f.factor, round(f.factor, 9) as wanted,
        ('0x' || substr(md5('mix-1:' || coalesce(t.doc_id::varchar, 'null')), 1, 12))::bigint::double / 281474976710656.0 as draw
      from t join f on t.source is not distinct from f.source and t.lang is not distinct from f.lang and t.topic is not distinct from f.topic),
    counted as (select *, floor(wanted)::bigint + (draw < wanted - floor(wanted))::bigint as n_copies from u)
    select doc_id, source, lang, topic, n as n_tokens, round(factor, 6) as factor, n_copies, n_copies > 0 as sampled from counted"""
    return ",\n".join([*steps, last])


FIM_SQL = """
    with d as (
      select doc_id, coalesce(text, '') as t, sha256('42:' || coalesce(doc_id::varchar, 'null')) as g,
        regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') as w
      from documents),
    h as (select *, len(w)::bigint as n, ('0x' || substr(g, 1, 8))::bigint as h1, ('0x' || substr(g, 9, 8))::bigint as h2,
        ('0x' || substr(g, 17, 8))::bigint as h3, ('0x' || substr(g, 25, 8))::bigint as h4 from d),
    c as (select *, least(h1 % (n + 1), h2 % (n + 1)) as a, greatest(h1 % (n + 1), h2 % (n + 1)) as b,
        case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or h3 % 100 >= 50 then 'plain'
             when h4 % 100 < 80 then 'spm' else 'psm' end as form from h),
    p as (select *, array_to_string(w[:a], '') as p, array_to_string(w[a + 1:b], '') as m, array_to_string(w[b + 1:], '') as s from c)
    select doc_id, n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
      sha256(case form when 'psm' then '<P>' || p || '<S>' || s || '<M>' || m when 'spm' then '<S>' || s || '<P>' || p || '<M>' || m else t end) as output_sha256,
      sha256(t) as restored_sha256 from p"""


def _tree_sql(name: str, leaves: str, group: str, levels: int) -> str:
    """Levels ``name_n0 ..`` (place, h, cnt) with the runs ``name_r0 ..`` below them, and ``name_top``: what is left of each group.

    ``levels`` is only an upper bound (8 ** levels leaves a group): a group with one node is not taken further.
    """
    steps = [f"{name}_n0 as materialized ({leaves})"]
    for k in range(levels):
        steps.append(
            f"{name}_r{k} as materialized (select {group}, place // 8 as run, string_agg(h, '' order by place) as joined from {name}_n{k} where cnt > 1 group by 1, 2), "
            f"{name}_n{k + 1} as materialized (select {group}, run as place, sha256(joined) as h, count(*) over (partition by {group}) as cnt from {name}_r{k})"
        )
    steps.append(f"{name}_top as (" + " union all ".join(f"select {group}, h from {name}_n{k} where cnt = 1" for k in range(levels + 1)) + ")")
    return ", ".join(steps)


def _up_sql(name: str, group: str, row: str, levels: int, source: str, out: str) -> str:
    """``out``: the rows of ``source`` with their siblings of all levels in ``proof`` and the node above their ``folded`` in ``folded``."""
    steps = [f"{out}_0 as (select * from {source})"]
    for k in range(levels):
        slot = f"64 * (({row} // {8**k}) % 8)"
        left, right = f"substr(r.joined, 1, {slot})", f"substr(r.joined, {slot} + 65)"
        steps.append(
            f"{out}_{k + 1} as (select s.* exclude (proof, folded), s.proof || coalesce({left} || {right}, '') as proof, "
            f"case when r.joined is null then s.folded else sha256({left} || s.folded || {right}) end as folded "
            f"from {out}_{k} s left join {name}_r{k} r on s.{group} is not distinct from r.{group} and s.{row} // {8 ** (k + 1)} = r.run)"
        )
    return ", ".join(steps) + f", {out} as (select * from {out}_{levels})"


def _manifest_sql(levels: int = 7, top_levels: int = 2) -> str:
    """The trees level by level, for up to 8 ** 7 rows of a language and 64 languages."""
    fields = ("doc_id", "source", "lang", "n_chars")

    def part(value: str) -> str:
        return f"coalesce(strlen({value}::varchar) || ':' || {value}::varchar, '-')"

    head = " || ".join(part(f) for f in fields)
    lower = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    crc = (
        "xor(list_reduce(list_prepend(4294967295::bigint, list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)), "
        "lambda a, c: list_reduce([xor(a, c), 0, 0, 0, 0, 0, 0, 0, 0]::bigint[], lambda x, y: xor(x >> 1, (x & 1) * 3988292384))), 4294967295::bigint)"
    )
    leaves = (
        "select doc_id, lang, h, changed, row_number() over (partition by lang order by doc_id nulls first, h) - 1 as place, "
        f"count(*) over (partition by lang) as cnt from (select doc_id, lang, sha256({head} || {part('text')}) as h, "
        f"case when {crc} % 3 = 0 then sha256({head} || {part(lower)}) end as changed from documents)"
    )
    tops = "select 0 as g, lang, h, row_number() over (order by lang nulls first) - 1 as place, count(*) over () as cnt from l_top"
    return (
        f"with {_tree_sql('l', leaves, 'lang', levels)}, {_tree_sql('t', tops, 'g', top_levels)}, "
        "start as (select doc_id, l.lang, l.h as leaf, l.place, 0 as g, t.place as top_place, t.h as subroot, '' as proof, coalesce(changed, l.h) as folded "
        "from l_n0 l join t_n0 t on l.lang is not distinct from t.lang), "
        f"{_up_sql('l', 'lang', 'place', levels, 'start', 'below')}, {_up_sql('t', 'g', 'top_place', top_levels, 'below', 'whole')} "
        "select doc_id, leaf, subroot, root.h as root, sha256(proof) as proof_sha256, folded as folded_root, folded = root.h as verified "
        "from whole, (select h from t_top) root"
    )


DECONTAMINATE_SQL = """
    with i as (
      select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
      from benchmark where text is not null),
    v as (
      select distinct item_id, least(10, len(w)) as size, array_to_string(w[k:k + least(10, len(w)) - 1], ' ') as win
      from i, unnest(range(1, greatest(len(w) - 9, 1) + 1)) as u(k) where len(w) > 0),
    d as (
      select row_number() over () as r, doc_id,
        regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') as w
      from documents),
    dw as materialized (select * from d),
    p as (select r, k, s.size, array_to_string(w[k:k + s.size - 1], ' ') as win from dw, (select distinct size from v) s, unnest(range(1, len(w) - s.size + 2)) as u(k)),
    m as materialized (select p.r, p.k, p.size, v.item_id from p join v on p.size = v.size and p.win = v.win),
    hit as (select r, count(distinct x) as n_hit from m, unnest(range(k, k + size)) as u(x) group by r),
    ids as (select r, count(distinct item_id) as n_items, string_agg(distinct item_id::varchar, ',' order by item_id::varchar) as listed from m group by r)
    select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items, sha256(coalesce(listed, '')) as items_sha256,
      coalesce(n_hit, 0) > 0 as contaminated
    from dw left join hit using (r) left join ids using (r)"""


ORACLES: dict[str, str] = {
    "op11_fim": FIM_SQL,
    "op12_merkle_manifest": _manifest_sql(),
    "op13_decontaminate": DECONTAMINATE_SQL,
    "op8_exact_dedup": """
        with n as (select doc_id, regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g') as t from documents)
        select doc_id, min(doc_id) over (partition by t) as keep_id, count(*) over (partition by t) as group_size,
          doc_id = min(doc_id) over (partition by t) as kept, sha256(t) as text_sha256 from n""",
    "op9_source_mixing": _mixing_sql(),
}
