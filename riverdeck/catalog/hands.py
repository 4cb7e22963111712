"""Hand lookups, totals and indexing status."""

from __future__ import annotations

from pyspark.sql import functions as F

from riverdeck.catalog.entry import Entry, over
from riverdeck.fixtures import view, with_views
from riverdeck.operators import folds
from riverdeck.operators import lookup as k
from riverdeck.session import scratch_path
from riverdeck.sources.tables import write_ranges, write_table

HANDS, RESULTS, CARDS, CHAIN = "fx_poker_hands", "fx_hand_results", "fx_revealed_cards", "fx_chain_events"
PAGE_START, PAGE_END, PAGE_SIZE, PAGE_OFFSET = 100, 900_000, 50, 10


def _with_lists(results):
    return results.withColumn("community_cards", F.split("community_cards", ","))


def _details(hands, results, cards):
    return k.hand_details(hands, _with_lists(results), cards)


def _status(hands, chain):
    return k.indexing_status(hands, folds.progress(chain))


def _status_of_chain(hands, chain):
    return k.indexing_status(hands, folds.progress(chain), 200_000)


def _newest(spark, sf_dir):
    """A page of the stored hands, from the files that can hold it."""
    root = scratch_path(spark, "index")
    write_table(view(spark, sf_dir, HANDS), root, "poker_hands", "block_height")
    write_ranges(spark, root, "poker_hands", "block_height")
    return k.newest_hands(spark, root, end_block=20_000, limit=30, offset=15)


def _absent(hands, results):
    """Table: hands with a result. Incoming: every hand, and a later copy of it."""
    columns = [*k.HAND_KEY, "block_height", "tx_hash"]
    started = hands.select(*columns)
    again = started.withColumn("block_height", F.col("block_height") + 1)
    return folds.insert_if_absent(results.select(*columns), again.unionByName(started), k.HAND_KEY, ["block_height"])


PROGRESS = """
, scanned as (select max(height) as last from fx_chain_events where height % 100 = 0)
"""
STATUS = PROGRESS + """
, figures as (select count(*) as hands, count(distinct game_id) as games, min(block_height) as lo
              from fx_poker_hands)
"""
FIGURES = """
, all_started as (select count(*) as hands, count(distinct game_id) as games, min(block_height) as lo,
                         max(block_height) as hi, min(indexed_at) as early, max(indexed_at) as late from fx_poker_hands),
  finished as (select count(*) as results from fx_hand_results),
  shown as (select count(*) as cards from fx_revealed_cards)
"""

ENTRIES = [
    over("hands_page", lambda hands: k.hands_page(
        hands, "g7", PAGE_START, PAGE_END, PAGE_SIZE, PAGE_OFFSET), HANDS, f"""
, matching as (select * from fx_poker_hands
               where game_id = 'g7' and block_height between {PAGE_START} and {PAGE_END})
select matching.*, (select count(*) from matching) as total from matching
order by block_height desc, hand_number desc, game_id limit {PAGE_SIZE} offset {PAGE_OFFSET}"""),
    Entry("newest_hands", _newest, with_views("""
select * from fx_poker_hands where block_height <= 20000
order by block_height desc, hand_number desc, game_id limit 30 offset 15""", HANDS)),
    over("hands_after", lambda hands: k.hands_after(hands, 1000, 1000, "g30"), HANDS, """
select * from fx_poker_hands where (-block_height, -hand_number, game_id) > (-1000, -1000, 'g30')
order by block_height desc, hand_number desc, game_id limit 50"""),
    over("hand_details", _details, f"{HANDS} {RESULTS} {CARDS}", """
, shown as (select game_id, hand_number, card_type, position, card, count(*) as times_revealed
            from fx_revealed_cards group by all)
select h.*, o.community_cards, o.winner_count, s.card_type, s.position, s.card,
       coalesce(s.times_revealed, 0) as times_revealed
from fx_poker_hands h
left join fx_hand_results o on o.game_id = h.game_id and o.hand_number = h.hand_number
left join shown s on s.game_id = h.game_id and s.hand_number = h.hand_number"""),
    over("hand_cards", lambda cards: k.hand_cards(cards, "g7", 104), CARDS, """
select card, card_type, position from fx_revealed_cards where game_id = 'g7' and hand_number = 104"""),
    over("total_hands_summary", k.totals, f"{HANDS} {RESULTS} {CARDS}", FIGURES + """
select hands as total_hands_started, results as total_hands_completed, cards as total_cards_revealed,
       games as unique_games, lo as first_block, hi as last_block
from all_started cross join finished cross join shown"""),
    over("stats_summary", k.stats_summary, f"{HANDS} {RESULTS} {CARDS}", FIGURES + """
select hands as total_hands, results as total_completed_hands, cards as total_revealed_cards,
       games as unique_games, concat_ws('-', lo, hi) as block_height_range, early as first_indexed_at,
       late as last_indexed_at
from all_started cross join finished cross join shown"""),
    over("indexing_status", _status, f"{HANDS} {CHAIN}", STATUS + """
select cast(0 as bigint) as total_blocks, last as blocks_indexed,
       cast(last as double) / cast(last as double) * 100 as percent_complete, last as last_block_indexed,
       lo as first_block_indexed, hands as total_hands, games as total_games
from scanned cross join figures"""),
    over("indexing_status_of_chain", _status_of_chain, f"{HANDS} {CHAIN}", STATUS + """
select cast(200000 as bigint) as total_blocks, last as blocks_indexed,
       cast(last as double) / cast(200000 as double) * 100 as percent_complete, last as last_block_indexed,
       lo as first_block_indexed, hands as total_hands, games as total_games
from scanned cross join figures"""),
    over("progress_fold", folds.progress, CHAIN, PROGRESS + """
select last as last_scanned_block, last as total_blocks_scanned from scanned"""),
    over("scan_gaps", k.scan_gaps, "fx_scanned_heights", """
select wanted.height as missing_block
from (select unnest(range((select min(height) from fx_scanned_heights),
                          (select max(height) + 1 from fx_scanned_heights))) as height) wanted
where wanted.height not in (select height from fx_scanned_heights)"""),
    over("insert_if_absent", _absent, f"{HANDS} {RESULTS}", """
select game_id, hand_number, block_height, tx_hash from fx_hand_results
union all
select game_id, hand_number, block_height, tx_hash from fx_poker_hands h
where not exists (select 1 from fx_hand_results o where o.game_id = h.game_id and o.hand_number = h.hand_number)"""),
]
