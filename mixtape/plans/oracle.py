"""Shared SQL building blocks for the DuckDB oracles (plain ANSI-ish SQL).

The views ``lineitem orders part ...`` are registered by the checker.
"""

from __future__ import annotations

from mixtape.sources.testview import DICTIONARY_CUTOFFS, HISTORY_CUTOFF, ORDER_BASKET


def raw_rows(where: str = "") -> str:
    """Raw playlist-track rows, one per line item (repeats kept)."""
    return f"""select o.o_custkey as playlist_id,
           concat('part:', cast(p.p_partkey as varchar)) as track_uri,
           p.p_name as track_name, p.p_brand as artist_name, p.p_type as album_name
    from lineitem l join orders o on l.l_orderkey = o.o_orderkey
                    join part p on l.l_partkey = p.p_partkey
    {('where ' + where) if where else ''}"""


def before(date: str) -> str:
    return f"o.o_orderdate < timestamp '{date} 00:00:00'"


def since(date: str) -> str:
    return f"o.o_orderdate >= timestamp '{date} 00:00:00'"


# raw / idx / ui over the whole data
UI_CTES = f"""raw as ({raw_rows()}),
idx as (select track, cast(row_number() over (order by track) as int) as id
        from (select distinct track_uri as track from raw) k),
ui as (select distinct r.playlist_id, r.track_uri, r.track_name, r.artist_name, r.album_name,
              idx.id as track_uri_index, 1 as rating
       from raw r left join idx on r.track_uri = idx.track),
pairs as (select distinct playlist_id, track_uri_index from ui where track_uri_index is not null),
catalog as (select distinct track_name, artist_name, album_name, track_uri from ui)"""

FIRST, SECOND = DICTIONARY_CUTOFFS


def _added(raw: str, known: str) -> str:
    """Ids for the keys of a batch that the dictionary lacks, after its largest id."""
    return f"""select track, cast((select coalesce(max(id), 0) from {known})
                          + row_number() over (order by track) as int) as id
          from (select distinct track_uri as track from {raw} where track_uri is not null
                except select track from {known}) k"""


# dictionary of the first batch, extended twice: up to the second date, then with the rest
INCREMENTAL_CTES = f"""old_raw as ({raw_rows(before(FIRST))}),
new_raw as ({raw_rows(since(FIRST))}),
mid_raw as ({raw_rows(since(FIRST) + " and " + before(SECOND))}),
late_raw as ({raw_rows(since(SECOND))}),
old_idx as (select track, cast(row_number() over (order by track) as int) as id
            from (select distinct track_uri as track from old_raw where track_uri is not null) k),
added_mid as ({_added("mid_raw", "old_idx")}),
mid_idx as (select * from old_idx union all select * from added_mid),
added_late as ({_added("late_raw", "mid_idx")}),
inc_idx as (select * from mid_idx union all select * from added_late),
versions as (select 1 as version, * from old_idx union all select 2 as version, * from added_mid
             union all select 3 as version, * from added_late)"""

# the first batch, then everything after it as one more
TWO_BATCH_CTES = f"""{INCREMENTAL_CTES},
added_rest as ({_added("new_raw", "old_idx")}),
two_idx as (select * from old_idx union all select * from added_rest)"""

HISTORY_CTES = f"""hist_raw as ({raw_rows(before(HISTORY_CUTOFF))}),
incoming_raw as ({raw_rows(since(HISTORY_CUTOFF))}),
incoming_orders as (select distinct {ORDER_BASKET} + l.l_orderkey as basket_id,
                           concat('part:', cast(l.l_partkey as varchar)) as track_uri
                    from lineitem l join orders o on l.l_orderkey = o.o_orderkey where {since(HISTORY_CUTOFF)})"""
