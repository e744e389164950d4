"""The three jobs of a run: store and edition, brief, content pack.

Each job writes the table that several of its outputs share to the cluster's shared folder, so the
text work runs once and a lost executor re-reads files instead of recomputing the chain.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame

from pressloom.functions.times import civil_day
from pressloom.operators import candidates as C
from pressloom.operators import edition as ED
from pressloom.operators import events as V
from pressloom.operators import package as PK
from pressloom.operators import stats as ST
from pressloom.operators import store as S
from pressloom.operators.candidates import utc
from pressloom.operators.dedup import merge_duplicates, merged_sources
from pressloom.operators.media import MediaRun, enrich_media, media_requests
from pressloom.operators.scale import written
from pressloom.operators.translate import MODEL, with_translation
from pressloom.policy import Policy
from pressloom.rules.pack import RulePack


def collect_job(store: S.RecordStore, fetched: DataFrame, now: dt.datetime) -> DataFrame:
    """Persist what was fetched before any selection; sources that failed lose nothing."""
    records = S.observations(S.project_news(fetched, keep=["arrival_seq"]), now)
    return store.read(store.merge(records))


@dataclass(frozen=True)
class Edition:
    merged: DataFrame
    items: DataFrame
    pool: DataFrame
    sources: DataFrame
    stats: DataFrame


def edition_job(records: DataFrame, registry: DataFrame, policy: Policy, pack: RulePack, now: dt.datetime,
                pages: DataFrame | None = None, media: MediaRun | None = None) -> Edition:
    """Stored records to the edition of the day, the uncapped pool, source links and counters.

    With ``media``, the media found on ``pages`` go back into the store and no page is asked for twice.
    """
    labelled = C.label_records(records, registry, policy, pack, now, keep_disabled=True)
    requests = None
    if pages is not None and media is not None:
        labelled, requests = media.enrich(labelled, pages, policy, pack, now)
    elif pages is not None:
        requests = media_requests(labelled, policy, pack, now)
        labelled = enrich_media(labelled, pages, policy, pack, now)
    found = C.candidate_columns(labelled, pack)
    merged = written(merge_duplicates(found, pack), "merged")
    items = ED.daily_edition(merged, policy, now).withColumn("edition_date", civil_day(utc(now)))
    return Edition(
        merged=merged,
        items=items,
        pool=ED.candidate_pool(merged, policy),
        sources=merged_sources(found),
        stats=ST.run_stats(labelled, policy, pack, now, requests),
    )


@dataclass(frozen=True)
class Brief:
    events: DataFrame
    filtered: DataFrame
    members: DataFrame
    trace: DataFrame
    stats: DataFrame


def brief_job(items: DataFrame, policy: Policy, pack: RulePack, cache: DataFrame | None = None, model: str = MODEL) -> Brief:
    """Edition items, with cached translations, to labelled events under the editorial budget."""
    if cache is not None:
        items = with_translation(items, cache, model)
    analysed = written(V.analyse(items, pack), "analysed")
    events = V.with_facts(written(V.group_events(analysed, pack), "groups"), analysed, pack)
    chosen = V.choose_events(V.relevance(events, pack), policy.editorial_budget)
    return Brief(
        events=chosen,
        filtered=V.low_signal(analysed),
        members=V.event_members(analysed),
        trace=V.trace_pool(chosen, analysed),
        stats=V.brief_stats(analysed, chosen),
    )


@dataclass(frozen=True)
class ContentPack:
    items: DataFrame
    manifest: DataFrame
    cards: DataFrame


def pack_job(pool: DataFrame, publish_day: dt.date, pack: RulePack, max_items: int = 5, allow_fallback: bool = False,
             edition_name: str = "") -> ContentPack:
    """The content pack of the day before, its manifest and card texts."""
    best = written(PK.package_select(pool, publish_day, max_items, allow_fallback), "pack")
    return ContentPack(best, PK.package_manifest(best, pack, publish_day, edition_name), PK.package_cards(best, pack))
