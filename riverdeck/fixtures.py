"""The library's input tables as views over the given tables.

Each view is SQL text both Spark and the checking engine accept; names in braces are the
tables and views it reads.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

VIEWS = {
    "fx_poker_hands": """
select concat('g', cast(o_orderkey % 97 as varchar(10))) as game_id,
       cast(o_orderkey as int) as hand_number, o_orderkey as block_height,
       case when o_orderkey % 211 = 0 then ''
            when o_orderkey % 50 = 0 then md5(cast(o_custkey % 7 as varchar(20)))
            else md5(cast(o_orderkey as varchar(20))) end as deck_seed,
       '' as deck, '' as tx_hash, o_orderdate as indexed_at
from {orders}""",
    "fx_revealed_cards": """
select concat('g', cast(l_orderkey % 97 as varchar(10))) as game_id,
       cast(l_orderkey as int) as hand_number, l_orderkey as block_height,
       case when l_partkey % 151 = 150 then '10S'
            else concat(substr('23456789TJQKA', cast(l_partkey % 52 % 13 as int) + 1, 1),
                        substr('hdcs', cast((l_partkey % 52 - l_partkey % 52 % 13) / 13 as int) + 1, 1)) end as card,
       case when l_linenumber <= 5 then 'community' else 'hole' end as card_type,
       case when l_linenumber <= 5 then l_linenumber - 1 else l_linenumber - 6 end as position,
       l_shipdate as indexed_at
from {lineitem}""",
    "fx_hand_results": """
select o.game_id, o.hand_number, o.block_height + 1 as block_height, c.community_cards,
       cast(1 + o.hand_number % 3 as int) as winner_count, '' as tx_hash, o.indexed_at
from {fx_poker_hands} o
join (select hand_number, concat_ws(',', min(case when position = 0 then card end), min(case when position = 1 then card end),
             min(case when position = 2 then card end), min(case when position = 3 then card end),
             min(case when position = 4 then card end)) as community_cards
      from {fx_revealed_cards} where card_type = 'community' group by hand_number) c
  on o.hand_number = c.hand_number""",
    "fx_player_actions": """
select concat('p', cast(user_id as varchar(20))) as player_address,
       concat('g', cast(event_id % 20 as varchar(10))) as game_id,
       cast((event_id - event_id % 10) / 10 as int) as hand_number, event_id + 1 as block_height,
       case event_type when 'click' then 'call' when 'view' then 'check' when 'purchase' then 'raise'
            when 'signup' then (case when event_id % 10 = 0 then 'all-in' else 'bet' end) else 'fold' end as action,
       cast(round(value * 100) as bigint) * 10000 as amount,
       case event_id % 4 when 0 then 'preflop' when 1 then 'flop' when 2 then 'turn' else 'river' end as round,
       ts as indexed_at
from {events}""",
    "fx_player_sessions": """
select concat('p', cast(o_custkey % 200 as varchar(20))) as player_address,
       concat('g', cast(o_orderkey % 20 as varchar(10))) as game_id, o_orderkey + 1 as join_block,
       case when o_orderstatus = 'O' then null else o_orderkey + 1 + o_custkey % 500 end as leave_block,
       cast(round(o_totalprice * 100) as bigint) * 10000 as buy_in_amount,
       case when o_orderstatus = 'O' then 0
            else cast(round(o_totalprice * 100) as bigint) * 100 * (50 + o_orderkey % 100) end as cash_out_amount,
       cast(o_orderkey % 40 as int) as hands_played, o_orderdate as indexed_at
from {orders}""",
    "fx_rake_rows": """
select concat('p', cast(o_custkey % 200 as varchar(20))) as player_address,
       cast(year(o_orderdate) as int) as year, cast(month(o_orderdate) as int) as month,
       cast(o_orderkey % 40 as int) as hands_played,
       cast(round(o_totalprice * 100) as bigint) * 20 as rake_contributed,
       cast(round(o_totalprice * 100) as bigint) * 100 * (o_orderkey % 100 - 50) as net_profit
from {orders}""",
    "fx_player_monthly_stats": """
select player_address, year, month, cast(sum(hands_played) as int) as hands_played,
       cast(sum(rake_contributed) as bigint) as rake_contributed, cast(sum(net_profit) as bigint) as net_profit
from {fx_rake_rows} group by 1, 2, 3""",
    "fx_player_tier": """
select concat('p', cast(o_custkey % 200 as varchar(20))) as player_address,
       case min(o_custkey % 200) % 6 when 0 then 'bronze' when 1 then 'silver' when 2 then 'gold'
            when 3 then 'platinum' when 4 then 'diamond' else null end as vip_tier
from {orders} group by 1""",
    "fx_chain_events": """
select cast((event_id - event_id % 10) / 10 as bigint) + 1 as height, cast(event_id % 10 as int) as event_seq,
       case when event_id % 10 in (0, 5) then 'hand_started' when event_id % 10 = 1 then 'hand_completed'
            when event_type = 'signup' then 'player_joined_game' when event_type = 'error' then 'player_left_game'
            else 'action_performed' end as type,
       concat('g', cast(user_id % 5 as varchar(10))) as game_id, concat('p', cast(user_id as varchar(10))) as player,
       cast((event_id - event_id % 70) / 70 as int) as hand_number,
       cast(round(value * 100) as bigint) * 10000 as amount,
       case event_type when 'click' then 'call' when 'view' then 'check' when 'purchase' then 'raise'
            when 'signup' then 'bet' else 'fold' end as action,
       md5(cast(event_id as varchar(20))) as deck_seed,
       case when event_id % 3 = 0 then 'Ah,Kd,,2c,Ts' else '9s,9h,4d' end as community_cards
from {events}""",
    # The chain events as the decoder yields them: string attributes, present only where the
    # type carries them, some block heights and winner counts malformed on purpose.
    "fx_events": """
select height, event_seq, type, game_id,
       case when type in ('action_performed', 'player_joined_game', 'player_left_game') then player end as player,
       case when type = 'action_performed' then action end as action,
       case when type = 'action_performed' then cast(amount as varchar(30)) end as amount,
       case when type in ('hand_started', 'hand_completed') then cast(hand_number as varchar(20)) end as hand_number,
       case when type = 'hand_started' then deck_seed end as deck_seed,
       case when type = 'hand_started' then concat('deck', cast(height % 7 as varchar(5))) end as deck,
       case when type = 'hand_completed' then community_cards end as community_cards,
       case when type = 'hand_completed' and height % 4 <> 0 then 'Qc,Jd,,8h' end as revealed_hole_cards,
       case when type = 'hand_completed' then
            (case when height % 11 = 0 then 'x' else cast(1 + hand_number % 3 as varchar(5)) end) end as winner_count,
       case when type = 'player_joined_game' then cast(amount as varchar(30)) end as buy_in_amount,
       case when type = 'player_left_game' then cast(amount + 1 as varchar(30)) end as refund_amount,
       case when type = 'hand_started' and hand_number % 3 = 0 then cast(height - 1 as varchar(20))
            when type = 'hand_started' and hand_number % 3 = 1 then 'n/a' end as block_height
from {fx_chain_events}""",
    # The same chain before dedicated hand events existed: some starts are new-hand actions.
    "fx_legacy_events": """
select height, event_seq,
       case when type = 'hand_started' and event_seq = 5 then 'action_performed' else type end as type, game_id, player,
       case when type = 'hand_started' and event_seq = 5 then 'new-hand' else action end as action, amount,
       case when type = 'hand_started' and event_seq = 5 then null else hand_number end as hand_number,
       case when type = 'hand_started' and event_seq = 5 then null else deck_seed end as deck_seed,
       case when type = 'hand_started' and event_seq = 5 then null else deck end as deck, community_cards,
       revealed_hole_cards, winner_count, buy_in_amount, refund_amount,
       case when type = 'hand_started' and event_seq = 5 then null else block_height end as block_height
from {fx_events}""",
    # The legacy chain with folds in the place of departures, so that showdowns are met too.
    "fx_mixed_events": """
select height, event_seq, case when type = 'player_left_game' then 'action_performed' else type end as type,
       game_id, player, case when type = 'player_left_game' then 'fold' else action end as action, amount,
       hand_number, deck_seed, deck, community_cards, revealed_hole_cards, winner_count, buy_in_amount,
       refund_amount, block_height
from {fx_legacy_events}""",
    # Every chain event read as an action, so that its folds can trigger showdowns.
    "fx_showdown_events": """
select height, event_seq, 'action_performed' as type, game_id, player, action from {fx_chain_events}""",
    # Scanned heights with gaps in them, for the query that looks for gaps.
    "fx_scanned_heights": """
select height from {fx_chain_events} where height % 97 < 96""",
    "fx_headers": """
select distinct height, upper(md5(cast(height as varchar(20)))) as app_hash from {fx_chain_events}""",
    # A snapshot of every game in every seventh block, from all events of those seven blocks;
    # the first blocks have none before them.
    "fx_game_states": """
select span + 5 as as_of_block, game_id, hand_number,
       case when amount % 40000 = 0 then 'showdown' else 'river' end as round,
       cast(amount / 10000 % 3 as int) as winner_count, amount
from (select height - height % 7 as span, game_id, max(hand_number) as hand_number, max(amount) as amount
      from {fx_chain_events} group by height - height % 7, game_id) s""",
}

BASE_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")


def _reads(view: str) -> list[str]:
    return list(dict.fromkeys(name for _, name, _, _ in Formatter().parse(VIEWS[view]) if name))


def _needed(views) -> list[str]:
    """The named views and all they read, each after what it reads."""
    ordered: list[str] = []
    for view in views:
        for name in [*_needed([n for n in _reads(view) if n in VIEWS]), view]:
            if name not in ordered:
                ordered.append(name)
    return ordered


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A fixture view as a DataFrame over the parquet tables in `sf_dir`."""
    if name in BASE_TABLES:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(VIEWS[name], **{read: view(spark, sf_dir, read) for read in _reads(name)})


def with_views(body: str, *names: str) -> str:
    """SQL text: the fixture views as a WITH clause, then `body` (which may add its own CTEs
    by starting with a comma)."""
    clauses = [f"{n} as ({VIEWS[n].format(**{r: r for r in _reads(n)})})" for n in _needed(names)]
    return "with " + ",\n".join(clauses) + "\n" + body
