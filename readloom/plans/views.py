"""Sequencing data derived from the given tables, in SQL that Spark and a second engine read alike."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "v_samples": """select n_nationkey as ord, n_name as sample,
        substr(translate(md5(n_name), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 6) as barcode from nation""",
    "v_pairs": """select event_id as rec_idx,
        '@S:1:F:1:' || cast(event_id % 7 as string) || ':' || cast(user_id as string) || ':' || cast(event_id as string) || ' 1:N:0' as name_f,
        '@S:1:F:1:' || cast(event_id % 7 as string) || ':' || cast(user_id as string) || ':' || cast(event_id as string) || ' 2:N:0' as name_r,
        translate(md5('f' || cast(event_id as string)) || md5('g' || cast(event_id as string)), '0123456789abcdef', 'ACGTACGTACGTACGN') as seq_f,
        translate(md5('r' || cast(event_id as string)) || md5('s' || cast(event_id as string)), '0123456789abcdef', 'ACGTACGTACGTACGN') as seq_r,
        translate(md5('p' || cast(event_id as string)) || md5('q' || cast(event_id as string)), '0123456789abcdef', '!#%+-./0159<?DFI') as qual_f,
        translate(md5('t' || cast(event_id as string)) || md5('u' || cast(event_id as string)), '0123456789abcdef', '!#%+-./0159<?DFI') as qual_r
        from events""",
    "v_merged": "select rec_idx, name_f as name, seq_f as seq, qual_f as qual from v_pairs",
    "v_bed": """select 'chr' || cast(o_custkey % 3 as string) as chrom, 100 + (o_orderkey * 7) % 211 as start_pos,
        100 + (o_orderkey * 7) % 211 + 20 + o_custkey % 3 as end_pos,
        'S:1:F:1:' || cast(o_custkey as string) || ':' || cast(o_orderkey % 13 as string) || ':' || cast(o_orderkey as string) || ':' ||
        substr(translate(md5(cast(o_orderkey as string)), '0123456789abcdef', 'AAAAAAAACCCCCCCC'), 1, 4) as name,
        cast(o_orderkey % 43 as int) as mapq, case when o_orderkey % 4 < 2 then '+' else '-' end as strand,
        case when o_orderkey % 3 = 0 then 'B' else 'A' end as replicate, o_orderstatus as sample from orders""",
    "v_fq": """select o_orderkey as rec_idx,
        '@S:1:F:1:1:' || cast(o_orderkey as string) || ':1:' || substr(translate(md5('u' || cast(o_orderkey % 5 as string)), '0123456789abcdef', 'ACGTACGTACGTACGT'), 1, 10) || ' 1:N:0' as name,
        translate(md5('d' || cast(o_custkey % 50 as string)), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq,
        translate(md5('q' || cast(o_orderkey as string)), '0123456789abcdef', '!#%+-./0159<?DFI') as qual from orders""",
    "v_contigs": """select s_suppkey as number, 's' || cast(s_suppkey as string) as chrom, translate(
        md5('a' || cast(s_suppkey as string)) || md5('b' || cast(s_suppkey as string)) || md5('c' || cast(s_suppkey as string)) || md5('d' || cast(s_suppkey as string)) || md5('e' || cast(s_suppkey as string)) || md5('f' || cast(s_suppkey as string)) || md5('g' || cast(s_suppkey as string)) || md5('h' || cast(s_suppkey as string)), '0123456789abcdef', 'ACGTACGTACGTACGT') as seq from supplier""",
    "v_sam": """select o_orderkey as rec_idx, 'S:1:F:1:' || cast(o_custkey as string) || ':' || cast(o_orderkey % 13 as string) || ':' || cast(o_orderkey as string) || ':ACGT' as qname,
        cast(case when o_orderkey % 50 = 0 then 4 when o_orderkey % 4 < 2 then 0 else 16 end as int) as flag,
        case when o_orderkey % 50 = 0 then '*' else 'chr' || cast(o_custkey % 3 as string) end as rname,
        case when o_orderkey % 50 = 0 then 0 else 1 + (o_orderkey * 7919) % 900001 end as pos, cast(o_orderkey % 43 as int) as mapq,
        case when o_orderkey % 50 = 0 then '*' when o_custkey % 4 = 0 then cast(5 + o_custkey % 8 as string) || 'M' || cast(1 + o_orderkey % 3 as string) || 'I' || cast(27 - o_custkey % 8 - 1 - o_orderkey % 3 as string) || 'M'
            when o_custkey % 4 = 1 then cast(5 + o_custkey % 8 as string) || 'S' || cast(27 - o_custkey % 8 as string) || 'M'
            when o_custkey % 4 = 2 then cast(5 + o_custkey % 8 as string) || 'M' || cast(100 + o_custkey % 50 as string) || 'N' || cast(27 - o_custkey % 8 as string) || 'M'
            else cast(5 + o_custkey % 8 as string) || '=' || cast(1 + o_orderkey % 3 as string) || 'D' || cast(27 - o_custkey % 8 as string) || 'X2H' end as cigar,
        '*' as rnext, cast(0 as bigint) as pnext, o_orderkey % 1000 - 500 as tlen,
        translate(md5(cast(o_orderkey as string)), '0123456789abcdef', 'ACGTACGTACGTACGN') as seq,
        translate(md5('q' || cast(o_orderkey as string)), '0123456789abcdef', '!#%+-./0159<?DFI') as qual,
        'NM:i:' || cast(o_custkey * 17 as string) as tag,
        case when o_orderkey % 50 = 0 then 0 when o_custkey % 4 = 0 then 32 - 1 - o_orderkey % 3 when o_custkey % 4 = 1 then 27 - o_custkey % 8
            when o_custkey % 4 = 2 then 132 + o_custkey % 50 else 33 + o_orderkey % 3 end as covered from orders""",
}
SOURCES = {"v_samples": "nation", "v_pairs": "events", "v_merged": "v_pairs", "v_bed": "orders", "v_fq": "orders", "v_sam": "orders", "v_contigs": "supplier"}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived view over the tables in ``sf_dir``."""
    source = SOURCES[name]
    below = view(spark, sf_dir, source) if source in VIEWS else spark.read.parquet(f"{sf_dir}/{source}.parquet")
    return spark.sql(VIEWS[name].replace(f"from {source}", "from {source}"), source=below)


def with_views(sql: str, *names: str) -> str:
    """The query with the views it uses in front."""
    needed = dict.fromkeys(n for name in names for n in ([SOURCES[name], name] if SOURCES[name] in VIEWS else [name]))
    return "with " + ",\n".join(f"{n} as ({VIEWS[n]})" for n in needed) + ("," if sql.lstrip().startswith("--more") else "") + "\n" + sql.replace("--more", "", 1)
