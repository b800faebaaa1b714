"""Queries over the driver's tables, one for each operator, and the same in SQL.

The tables hold no recordings, so labels are a view of documents (scores are functions of doc_id),
reviews one of events, conversations are neighbours, and parts stand for short utterances. The SQL states
each result in another way than the DataFrame plan where there is one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.alignment import diff_ops, md5_rank, stable_rank
from .functions.matching import match_callsign
from .functions.text import canonical_callsigns, normalize, present_tails, shard_stem, similarity, spoken_realizations, token_distance, tokens
from .functions.voting import rover
from .operators.context import conversation_window, group_tracks, neighbours
from .operators.ensemble import agreement_score, classify_tier, clique_size, confidence_score, is_non_speech, pair_similarities
from .operators.review import effective, published, replay, review_offset, standing, training_rows
from .operators.snapshot import canonical, shard_digests, snapshot_digest, tier_counts
from .operators.tables import duration_buckets, join_voters, last_wins, next_unreviewed, pending, replica_of, shard_counts
from .operators.worklist import boundary, calibration, flag_reviewed, gold_validation, queue_counts, review_plan, review_queue
from .plans.stages import correction_prompt, fuse, transcript_grammar
from .session import numbered
from .sinks.effects import first_answers
from .sources.parquet import zip_rows
from .sources.shards import expand_spec

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _share(c: Column) -> Column:
    return (c % 101).cast("double") / 100.0


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("doc_id")
    base = _table(spark, sf_dir, "documents").select(
        d.alias("utterance_id"), (d % 8).cast("int").alias("shard"), d.alias("pos"), _share(d * 37).alias("agreement_score"), _share(d * 53).alias("rover_confidence"),
        F.when(d % 3 != 0, _share(d * 71)).alias("advisory_disagree"), (1 + d % 3).cast("long").alias("n_models_agree"), (d % 17 == 0).alias("_silent"),
        (d % 5 != 0).alias("callsign_matched"), F.col("source").alias("transcript"), F.col("lang").alias("callsign_tail"),
    )
    tier = classify_tier(F.col("_silent"), F.col("n_models_agree"), 3, F.col("callsign_matched"), F.col("agreement_score"))
    return base.withColumn("tier", tier).drop("_silent")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    named = F.when(kind == "click", "accept").when(kind == "view", "edit").when(kind == "purchase", "reject").when(kind == "signup", "non_speech")
    return _table(spark, sf_dir, "events").select(
        F.col("user_id").alias("utterance_id"), F.col("event_id").alias("seq"), F.when(kind == "error", "undo").otherwise("set").alias("action"),
        named.alias("decision"), kind.alias("transcript"),
    )


def effective_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return effective(labels(spark, sf_dir), replay(events(spark, sf_dir)))


LABELS_V = """labels_v as (
 select *, case when non_speech then 'non_speech' when n_agree = 3 and callsign_ok then 'gold'
   when agreement_score >= cast(0.3 as double) then 'silver' else 'tail' end as tier from (
 select doc_id, cast(doc_id % 8 as int) as shard, doc_id as pos, lang,
  cast(doc_id*37 % 101 as double)/cast(100 as double) as agreement_score,
  cast(doc_id*53 % 101 as double)/cast(100 as double) as rover_confidence,
  case when doc_id % 3 = 0 then null else cast(doc_id*71 % 101 as double)/cast(100 as double) end as advisory_disagree,
  1 + doc_id % 3 as n_agree, doc_id % 17 = 0 as non_speech, doc_id % 5 <> 0 as callsign_ok,
  source as transcript from documents) b)"""
CURRENT_V = """ev as (select user_id as doc_id, event_id as seq, case when event_type='error' then 'undo' else 'set' end as action,
  case event_type when 'click' then 'accept' when 'view' then 'edit' when 'purchase' then 'reject' when 'signup' then 'non_speech' end as decision,
  event_type as human_text from events),
ev1 as (select *, sum(case when action='set' then 1 else -1 end) over (partition by doc_id order by seq) as run from ev),
ev2 as (select *, run - least(0, min(run) over (partition by doc_id order by seq)) as depth from ev1),
ev3 as (select *, last_value(depth) over (partition by doc_id order by seq rows between unbounded preceding and unbounded following) as fd from ev2),
ev4 as (select *, row_number() over (partition by doc_id order by seq desc) as rn from ev3 where action='set' and depth=fd and fd>=1),
current_v as (select doc_id, seq, decision, human_text from ev4 where rn=1)"""
EFFECTIVE_V = f"""{LABELS_V}, {CURRENT_V}, effective_v as (select l.*, c.decision is not null as reviewed, c.decision as review_decision,
  case when c.decision is null then l.transcript when c.decision='edit' then c.human_text when c.decision='accept' then l.transcript else '' end as effective_transcript,
  case when c.decision is null then 'model' when c.decision='accept' then 'human-confirmed' else 'human' end as origin
  from labels_v l left join current_v c on l.doc_id=c.doc_id)"""


# Scans, projections, sets


@query("select doc_id, source as airport, list_filter([lang, '', null, source], lambda x: x is not null and x <> '') as tails from documents")
def scan_projection_meta(spark, sf_dir):
    raw = F.array("lang", F.lit(""), F.lit(None).cast("string"), "source")
    return _table(spark, sf_dir, "documents").select("doc_id", F.col("source").alias("airport"), present_tails(raw).alias("tails"))


@query("with s as (select distinct unnest(generate_series(n_regionkey, n_nationkey)) as shard from nation) select cast(shard as int) as shard, 'shard-' || lpad(cast(shard as varchar), 5, '0') as stem from s")
def shard_spec_prune(spark, sf_dir):
    return expand_spec(_table(spark, sf_dir, "nation"), "n_regionkey", "n_nationkey").select(F.col("shard").cast("int"), shard_stem(F.col("shard").cast("int")).alias("stem"))


@query("select distinct shard from (select cast(doc_id % 8 as int) as shard from documents) where shard not in (select cast(n_regionkey as int) from nation)")
def resume_pending_anti(spark, sf_dir):
    done = _table(spark, sf_dir, "nation").select(F.col("n_regionkey").cast("int").alias("shard"))
    return pending(labels(spark, sf_dir).select("shard"), done)


@query("""with r as (select user_id, event_id, event_type, value, row_number() over (partition by user_id order by event_id desc) as n,
 min(event_id) over (partition by user_id) as first from events) select user_id, event_type, value, first as event_id from r where n = 1""")
def dedupe_last_wins(spark, sf_dir):
    return last_wins(_table(spark, sf_dir, "events").select("user_id", "event_type", "value", "event_id"), ["user_id"], order="event_id")


@query("""with a as (select distinct c_nationkey as k from customer), b as (select distinct s_nationkey as k from supplier)
select k, 'union' as kind from a union select k, 'union' from b union all
(select k, 'difference' as kind from a except select k, 'difference' from b) union all (select k, 'both' as kind from a intersect select k, 'both' from b)""")
def set_ops_ids(spark, sf_dir):
    a = _table(spark, sf_dir, "customer").select(F.col("c_nationkey").alias("k")).distinct()
    b = _table(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("k")).distinct()
    named = lambda df, kind: df.withColumn("kind", F.lit(kind))
    return named(a.union(b).distinct(), "union").unionByName(named(a.join(b, "k", "left_anti"), "difference")).unionByName(named(a.join(b, "k", "left_semi"), "both"))


# Ensemble


@query(f"with {LABELS_V} select doc_id, tier from labels_v")
def tier_classify(spark, sf_dir):
    return labels(spark, sf_dir).select(F.col("utterance_id").alias("doc_id"), "tier")


@query(f"""with {LABELS_V} select doc_id, case when advisory_disagree is null then (agreement_score + rover_confidence) / 2
 else (agreement_score + rover_confidence + (1 - advisory_disagree)) / 3 end as confidence from labels_v""")
def confidence_mean(spark, sf_dir):
    score = confidence_score(F.col("agreement_score"), F.col("rover_confidence"), F.col("advisory_disagree"))
    return labels(spark, sf_dir).select(F.col("utterance_id").alias("doc_id"), score.alias("confidence"))


@query("""select doc_id, (case when lang = 'en' then 1 else 0 end + case when source is null then 1 else 0 end + case when length(trim(text)) = 0 then 1 else 0 end) * 2 >= 3
 or cast(doc_id*53 % 101 as double)/cast(100 as double) > cast(0.6 as double) as non_speech from documents""")
def nonspeech_flag(spark, sf_dir):
    docs = _table(spark, sf_dir, "documents")
    texts = F.array(F.when(F.col("lang") != "en", F.col("lang")).otherwise(""), F.col("source"), F.trim(F.col("text")))
    return docs.select("doc_id", is_non_speech(texts, F.array(_share(F.col("doc_id") * 53), F.lit(None).cast("double"))).alias("non_speech"))


def _voter_rows(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Parts as utterances: name, type and brand are three voters; some parts lack the second or the advisory."""
    part = _table(spark, sf_dir, "part")
    key = F.col("p_partkey").alias("utterance_id")
    meta = part.select(key, (F.col("p_partkey") % 4).cast("int").alias("shard"))
    models = [("v1", F.col("p_name"), F.lit(True)), ("v2", F.col("p_type"), F.col("p_partkey") % 7 != 0), ("v3", F.col("p_brand"), F.lit(True)), ("adv", F.col("p_name"), F.col("p_partkey") % 3 == 0)]
    each = F.array(*[F.struct(F.lit(m).alias("model"), t.alias("text"), (F.col("p_size") / 100.0).alias("no_speech"), keep.alias("keep")) for m, t, keep in models])
    return meta, part.select(key, F.explode(each).alias("h")).filter("h.keep").select("utterance_id", "h.model", "h.text", "h.no_speech")


@query("select p_partkey, p_name as a, p_type as b, p_brand as c, p_size / 100.0 as no_speech from part where p_partkey % 7 <> 0")
def voter_inner_join(spark, sf_dir):
    meta, hyps = _voter_rows(spark, sf_dir)
    v = F.col("voting")
    return join_voters(meta, hyps, ["v1", "v2", "v3"]).select(
        F.col("utterance_id").alias("p_partkey"), v[0]["text"].alias("a"), v[1]["text"].alias("b"), v[2]["text"].alias("c"), v[0]["no_speech"].alias("no_speech")
    )


@query("select p_partkey, p_brand as a, case when p_partkey % 3 = 0 then p_name end as advisory, p_partkey % 3 = 0 as has_advisory from part")
def advisory_left_join(spark, sf_dir):
    meta, hyps = _voter_rows(spark, sf_dir)
    got = join_voters(meta, hyps, ["v3"], advisory="adv")
    return got.select(F.col("utterance_id").alias("p_partkey"), F.col("voting")[0]["text"].alias("a"), F.col("advisory.text").alias("advisory"), F.col("advisory").isNotNull().alias("has_advisory"))


@query("select cast(p_partkey % 4 as int) as shard, count(*) filter (p_partkey % 7 <> 0) as labelled, count(*) filter (p_partkey % 7 = 0) as skipped from part group by 1")
def missing_voter_count(spark, sf_dir):
    meta, hyps = _voter_rows(spark, sf_dir)
    return shard_counts(meta, join_voters(meta, hyps, ["v1", "v2", "v3"]))


def _variants(spark, sf_dir) -> DataFrame:
    p = _table(spark, sf_dir, "part")
    n, name, kind = F.col("p_partkey"), F.col("p_name"), F.lower("p_type")
    return p.select(
        n, F.concat_ws(" ", name, kind).alias("a"), F.when(n % 3 == 0, F.concat_ws(" ", kind, name)).when(n % 3 == 1, F.concat_ws(" ", name, kind)).otherwise(name).alias("b"),
        F.when(n % 4 == 0, name).otherwise(F.concat_ws(" ", name, kind, F.lit("over"))).alias("c"),
    )


VARIANTS_V = """v as (select p_partkey, p_name || ' ' || lower(p_type) as a,
 case p_partkey % 3 when 0 then lower(p_type) || ' ' || p_name when 1 then p_name || ' ' || lower(p_type) else p_name end as b,
 case when p_partkey % 4 = 0 then p_name else p_name || ' ' || lower(p_type) || ' over' end as c from part),
w as (select *, string_split(a, ' ') as x, string_split(b, ' ') as y, string_split(c, ' ') as z from v),
k as (select *, list_distinct(list_concat(x, y, z)) as words from w),
e as (select *, array_to_string(list_transform(x, lambda t: chr(cast(64 + list_position(words, t) as int))), '') as ex,
 array_to_string(list_transform(y, lambda t: chr(cast(64 + list_position(words, t) as int))), '') as ey,
 array_to_string(list_transform(z, lambda t: chr(cast(64 + list_position(words, t) as int))), '') as ez from k),
s as (select p_partkey, levenshtein(ex, ey) as dab,
 1 - cast(levenshtein(ex, ey) as double) / greatest(len(x), len(y)) as ab, 1 - cast(levenshtein(ex, ez) as double) / greatest(len(x), len(z)) as ac,
 1 - cast(levenshtein(ey, ez) as double) / greatest(len(y), len(z)) as bc from e)"""


@query(f"with {VARIANTS_V} select p_partkey, cast(dab as int) as distance from s")
def token_levenshtein(spark, sf_dir):
    return _variants(spark, sf_dir).select("p_partkey", token_distance(tokens(F.col("a")), tokens(F.col("b"))).alias("distance"))


@query(f"with {VARIANTS_V} select p_partkey, (ab + ac + bc) / 3 as agreement_score from s")
def pairwise_agreement(spark, sf_dir):
    pairs = pair_similarities([F.col("a"), F.col("b"), F.col("c")])
    return _variants(spark, sf_dir).select("p_partkey", agreement_score(list(pairs.values())).alias("agreement_score"))


@query(f"""with {VARIANTS_V} select p_partkey, case when 1-ab <= cast(0.2 as double) and 1-ac <= cast(0.2 as double) and 1-bc <= cast(0.2 as double) then 3
 when 1-ab <= cast(0.2 as double) or 1-ac <= cast(0.2 as double) or 1-bc <= cast(0.2 as double) then 2 else 1 end as n_agree from s""")
def agree_clique(spark, sf_dir):
    pairs = pair_similarities([F.col("a"), F.col("b"), F.col("c")])
    cols = {p: f"s{p[0]}{p[1]}" for p in pairs}
    scored = _variants(spark, sf_dir).select("p_partkey", *[c.alias(cols[p]) for p, c in pairs.items()])
    return scored.select("p_partkey", clique_size({p: F.col(c) for p, c in cols.items()}, 3).cast("int").alias("n_agree"))


_NORMAL = "lower(text)"
for _digit, _word in enumerate("zero one two three four five six seven eight nine".split()):
    _NORMAL = f"replace({_NORMAL}, '{_digit}', ' {_word} ')"


@query(rf"select conv_id, turn, trim(regexp_replace(replace({_NORMAL}, '''', ''), '[^\p{{L}}\p{{M}}]+', ' ', 'g')) as normal from conversations")
def normalize_text(spark, sf_dir):
    return _table(spark, sf_dir, "conversations").select("conv_id", "turn", normalize(F.col("text")).alias("normal"))


@query(r"select p_partkey, regexp_extract(p_brand, '(\d.*)$', 1) as suffix from part")
def callsign_suffix(spark, sf_dir):
    return _table(spark, sf_dir, "part").select("p_partkey", F.regexp_extract("p_brand", r"(\d.*)$", 1).alias("suffix"))


_SPELL = ", ".join(
    f"'{c}': '{w}'" for c, w in zip(
        "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ",
        ("zero one two three four five six seven eight nine alfa bravo charlie delta echo foxtrot golf hotel india juliett kilo lima mike november oscar papa "
         "quebec romeo sierra tango uniform victor whiskey xray yankee zulu").split(), strict=True,
    )
)


@query(f"""select c_custkey, [array_to_string(list_transform(string_split(t, ''), lambda c: map {{{_SPELL}}}[c]), ' ') for t in
 ['N' || c_custkey, upper(c_mktsegment)]] as spoken from customer""")
def spoken_callsigns(spark, sf_dir):
    tails = F.array(F.concat(F.lit("N"), F.col("c_custkey").cast("string")), F.lit(""), F.col("c_mktsegment"))
    return _table(spark, sf_dir, "customer").select("c_custkey", canonical_callsigns(tails).alias("spoken"))


# Review


@query(f"with {CURRENT_V} select doc_id, seq, decision, human_text as transcript from current_v")
def review_replay_current(spark, sf_dir):
    return replay(events(spark, sf_dir)).select(F.col("utterance_id").alias("doc_id"), "seq", "decision", "transcript")


@query(f"with {CURRENT_V} select doc_id from current_v")
def reviewed_ids(spark, sf_dir):
    return replay(events(spark, sf_dir)).select(F.col("utterance_id").alias("doc_id"))


@query(f"""with {CURRENT_V}, stacks as (select *, min(depth) over (partition by doc_id order by seq rows between 1 following and unbounded following) as low from ev2)
select doc_id, count(*) as standing, max(seq) as last_seq from stacks where action = 'set' and depth >= 1 and coalesce(low, depth) >= depth group by doc_id""")
def review_standing(spark, sf_dir):
    """What a desk keeps between requests: the sets on each key's stack."""
    return standing(events(spark, sf_dir)).groupBy(F.col("utterance_id").alias("doc_id")).agg(F.count(F.lit(1)).alias("standing"), F.max("seq").alias("last_seq"))


@query("select coalesce(max(event_id) + 1, 0) as review_offset from events")
def review_offset_next(spark, sf_dir):
    return review_offset(events(spark, sf_dir))


@query(f"with {EFFECTIVE_V} select doc_id, reviewed, review_decision, effective_transcript, origin from effective_v")
def effective_merge(spark, sf_dir):
    return effective_labels(spark, sf_dir).select(F.col("utterance_id").alias("doc_id"), "reviewed", "review_decision", "effective_transcript", F.col("source").alias("origin"))


@query(f"""with {EFFECTIVE_V} select doc_id, effective_transcript as transcript, case when review_decision in ('accept','edit','non_speech') then 1.0::double
 when review_decision = 'reject' then 0.0::double when advisory_disagree is null then (agreement_score + rover_confidence) / 2
 else (agreement_score + rover_confidence + (1 - advisory_disagree)) / 3 end as confidence,
 case when review_decision is null then 'auto' when review_decision = 'accept' then 'verified' when review_decision = 'edit' then 'edited'
 when review_decision = 'reject' then 'rejected' else 'non_speech' end as review_status, agreement_score, rover_confidence, advisory_disagree,
 n_agree as n_models_agree, callsign_ok as callsign_matched, lang as callsign_tail from effective_v""")
def publish_projection(spark, sf_dir):
    return published(effective_labels(spark, sf_dir)).withColumnRenamed("utterance_id", "doc_id")


@query(f"""with {EFFECTIVE_V} select doc_id, effective_transcript as transcript, tier, origin, reviewed from effective_v
 where effective_transcript <> '' and case when reviewed then review_decision in ('accept','edit') else tier in ('gold','silver') end""")
def trainset_filter(spark, sf_dir):
    return training_rows(effective_labels(spark, sf_dir)).select(F.col("utterance_id").alias("doc_id"), "transcript", "tier", F.col("source").alias("origin"), "reviewed")


@query(f"with {EFFECTIVE_V} select tier, count(*) as n from effective_v group by rollup(tier)")
def snapshot_counts(spark, sf_dir):
    return tier_counts(effective_labels(spark, sf_dir))


_LINES = f"""{EFFECTIVE_V}, digests as (select shard, sha256(string_agg(concat_ws('|', cast(doc_id as varchar), tier, effective_transcript, origin), chr(10) order by doc_id)) as digest
 from effective_v group by shard)"""


def _digests(spark, sf_dir) -> DataFrame:
    line = F.concat_ws("|", F.col("utterance_id").cast("string"), "tier", "effective_transcript", "source")
    return shard_digests(effective_labels(spark, sf_dir), line)


@query(f"with {_LINES} select shard, digest from digests")
def snapshot_shard_digest(spark, sf_dir):
    return _digests(spark, sf_dir)


@query(f"""with {_LINES} select sha256(string_agg('shard-' || lpad(cast(shard as varchar), 5, '0') || ':' || digest, chr(10) order by shard)) as digest from digests""")
def snapshot_digest_all(spark, sf_dir):
    return snapshot_digest(_digests(spark, sf_dir))


@query("""select doc_id, sha256('{"doc_id":' || doc_id || ',"lang":' || coalesce('"' || lang || '"', 'null') || ',"n_chars":' || coalesce(cast(n_chars as varchar), 'null')
 || ',"source":' || coalesce('"' || source || '"', 'null') || '}') as digest from documents""")
def canonical_json(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.sha2(canonical(["source", "n_chars", "lang", "doc_id"]), 256).alias("digest"))


@query("""with o as (select row_number() over () - 1 as pos, o_orderkey from orders), c as (select row_number() over () - 1 as pos, c_custkey, c_name from customer)
select o.pos, o_orderkey, c_custkey, c_name from o join c on o.pos = c.pos""")
def rows_by_place(spark, sf_dir):
    """The nth row of one file with the nth of another, each table being one shard."""
    at = [F.lit(0).alias("shard"), F.col("_metadata.row_index").alias("pos")]
    left = _table(spark, sf_dir, "orders").select(*at, "o_orderkey")
    right = _table(spark, sf_dir, "customer").select(*at, "c_custkey", "c_name")
    return zip_rows(left, right).drop("shard")


# Worklist


def _flagged(spark, sf_dir) -> DataFrame:
    return flag_reviewed(labels(spark, sf_dir), replay(events(spark, sf_dir)))


@query(f"""with {EFFECTIVE_V} select doc_id, shard, reviewed, row_number() over (order by shard, coalesce(advisory_disagree, 0.0::double) desc, agreement_score, pos) as position
 from effective_v where tier in ('silver','tail')""")
def worklist_order(spark, sf_dir):
    return review_queue(_flagged(spark, sf_dir)).select(F.col("utterance_id").alias("doc_id"), "shard", "reviewed", "position")


@query(f"""with {EFFECTIVE_V}, q as (select * from effective_v where tier in ('silver','tail')) select count(*) as total, count(*) filter (reviewed) as reviewed,
 count(*) filter (not reviewed) as remaining, count(*) filter (tier='silver') as silver_total, count(*) filter (tier='silver' and reviewed) as silver_reviewed,
 count(*) filter (tier='silver' and not reviewed) as silver_remaining, count(*) filter (tier='tail') as tail_total,
 count(*) filter (tier='tail' and reviewed) as tail_reviewed, count(*) filter (tier='tail' and not reviewed) as tail_remaining from q""")
def queue_stats(spark, sf_dir):
    return queue_counts(_flagged(spark, sf_dir))


PLAN_V = f"""{EFFECTIVE_V}, pool as (select *, md5(cast(doc_id as varchar)) as rk from effective_v where tier<>'non_speech'),
g0 as (select *, row_number() over (order by rk, doc_id) as r from pool where tier='gold'),
gold as (select doc_id, row_number() over (order by r) as p from g0 where r<=50 and not reviewed),
c0 as (select doc_id, bin, row_number() over (partition by bin order by rk, doc_id) as r from (select doc_id, rk,
 least(9,greatest(0,cast(floor(agreement_score*cast(10 as double)) as int))) as bin from pool) x),
c1 as (select doc_id, row_number() over (order by r, bin) as p from c0),
c2 as (select doc_id, p from c1 where p<=100),
cal as (select c2.doc_id, row_number() over (order by c2.p) as p from c2 left join gold on c2.doc_id=gold.doc_id where gold.doc_id is null),
nc as (select count(*) as n from cal),
b0 as (select pool.doc_id, row_number() over (order by abs(agreement_score-cast(0.3 as double)), coalesce(advisory_disagree,cast(0 as double)) desc, rk, pool.doc_id) as p
  from pool left join gold on pool.doc_id=gold.doc_id left join cal on pool.doc_id=cal.doc_id
  where gold.doc_id is null and cal.doc_id is null and (abs(agreement_score-cast(0.3 as double))<=cast(0.1 as double)
   or (tier in ('gold','silver') and coalesce(advisory_disagree,cast(0 as double))>=cast(0.5 as double)))),
bnd as (select doc_id,p from b0 cross join nc where p<=200-nc.n),
u as (select doc_id,'gold-validation' as reason,0 as k,p,0 as t from gold union all select doc_id,'boundary',1,p,0 from bnd union all select doc_id,'calibration',1,p,1 from cal)"""


def _pool(spark, sf_dir) -> DataFrame:
    return _flagged(spark, sf_dir).filter("tier <> 'non_speech'").withColumn("_rank", md5_rank(F.col("utterance_id")))


def _placed(df: DataFrame) -> DataFrame:
    return df.select(F.col("utterance_id").alias("doc_id"), "place")


@query(f"with {PLAN_V} select doc_id, p as place from gold")
def gold_validation_top(spark, sf_dir):
    return _placed(gold_validation(_pool(spark, sf_dir)))


@query(f"with {PLAN_V} select doc_id, p as place from c2")
def calibration_round_robin(spark, sf_dir):
    return _placed(calibration(_pool(spark, sf_dir), 100))


@query(f"""with {PLAN_V} select doc_id, row_number() over (order by abs(agreement_score-cast(0.3 as double)), coalesce(advisory_disagree,cast(0 as double)) desc, rk, doc_id) as place
 from pool where abs(agreement_score-cast(0.3 as double))<=cast(0.1 as double) or (tier in ('gold','silver') and coalesce(advisory_disagree,cast(0 as double))>=cast(0.5 as double))
 qualify place <= 150""")
def boundary_topk(spark, sf_dir):
    return _placed(boundary(_pool(spark, sf_dir), 150))


@query(f"with {PLAN_V} select doc_id, reason, row_number() over (order by k,p,t) as position from u")
def review_plan_200(spark, sf_dir):
    return review_plan(_flagged(spark, sf_dir), 200, md5_rank).withColumnRenamed("utterance_id", "doc_id")


@query(f"""with {EFFECTIVE_V}, q as (select doc_id, reviewed, row_number() over (order by shard, coalesce(advisory_disagree, 0.0::double) desc, agreement_score, pos) as position
 from effective_v where tier in ('silver','tail')) select doc_id, position from q where not reviewed order by position < 40, position limit 1""")
def next_unreviewed_item(spark, sf_dir):
    return next_unreviewed(review_queue(_flagged(spark, sf_dir)), 40).select(F.col("utterance_id").alias("doc_id"), "position")


@query("""select a.conv_id, a.turn, count(*) as n, string_agg(b.role, ',' order by b.turn) as roles from conversations a
 join conversations b on a.conv_id = b.conv_id and b.turn between a.turn - 3 and a.turn + 3 group by all""")
def conversation_window_3(spark, sf_dir):
    rows = _table(spark, sf_dir, "conversations").select("conv_id", "turn", "role")
    got = conversation_window(rows, "conv_id", "turn", F.col("role"))
    return got.select("conv_id", "turn", F.size("conversation").cast("long").alias("n"), F.array_join("conversation", ",").alias("roles"))


@query("""select a.conv_id, a.turn, b.turn as neighbour, cast(b.turn - a.turn as int) as "offset" from conversations a
 join conversations b on a.conv_id = b.conv_id and b.turn between a.turn - 3 and a.turn + 3""")
def conversation_neighbours(spark, sf_dir):
    return neighbours(_table(spark, sf_dir, "conversations").select("conv_id", "turn"), "conv_id", "turn")


@query("select doc_id, cast(floor((row_number() over (order by n_chars, doc_id) - 1) / 64) as bigint) as bucket from documents")
def duration_buckets_64(spark, sf_dir):
    return duration_buckets(_table(spark, sf_dir, "documents").select("doc_id", "n_chars"), "n_chars", 64, "doc_id").select("doc_id", "bucket")


@query("select n_nationkey as shard, cast((row_number() over (order by n_nationkey) - 1) % 3 as int) as replica from nation")
def replica_round_robin(spark, sf_dir):
    return replica_of(_table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("shard")), 3).select("shard", F.col("replica").cast("int"))


@query("select o_orderkey, row_number() over (order by o_totalprice desc, o_orderkey) as position from orders")
def global_positions(spark, sf_dir):
    return numbered(_table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice"), F.col("o_totalprice").desc(), F.col("o_orderkey")).select("o_orderkey", "position")


# Sequential text algorithms and nested rows: checked in tests against plain models


def _heard(spark, sf_dir) -> DataFrame:
    """Turns as utterances that three voters hear: whole, without its stops' words, and upper case without every seventh word."""
    rows = _table(spark, sf_dir, "conversations")
    words = F.split("text", r"\s+")
    return rows.select(
        "conv_id", "turn", F.col("text").alias("a"), F.regexp_replace("text", r"\S+\.", "").alias("b"),
        F.upper(F.array_join(F.filter(words, lambda w, i: i % 7 != 3), " ")).alias("c"),
    )


@query()
def rover_vote(spark, sf_dir):
    voted = rover(F.array("a", "b", "c"), F.array(F.lit(1.0), F.lit(1.0), F.lit(2.0)))
    return _heard(spark, sf_dir).withColumn("v", voted).select("conv_id", "turn", F.col("v.text").alias("text"), F.col("v.confidence").alias("confidence"))


@query()
def diff_ops_words(spark, sf_dir):
    return _heard(spark, sf_dir).select("conv_id", "turn", diff_ops(F.col("a"), F.col("b")).alias("ops"))


@query()
def callsign_snap(spark, sf_dir):
    cust = _table(spark, sf_dir, "customer")
    tail = F.concat(F.lit("N"), F.col("c_custkey").cast("string"), F.upper(F.substring("c_mktsegment", 1, 2)))
    spoken = F.concat_ws(" ", F.element_at(spoken_realizations(tail), 1), F.lit("descend and maintain"), F.lower("c_name"))
    heard = F.when(F.col("c_custkey") % 2 == 0, spoken).otherwise(F.regexp_replace(spoken, "november", "novembr"))
    found = cust.select("c_custkey", match_callsign(heard, F.array(F.lit("DAL1234"), tail)).alias("m"))
    return found.select("c_custkey", "m.tail", "m.score", "m.matched", "m.text", "m.snapped")


@query()
def blake_rank(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", F.hex(stable_rank(F.col("doc_id"))).alias("rank"))


@query()
def track_grouping(spark, sf_dir):
    point = F.struct(
        F.col("ts").alias("t"), F.col("event_type").alias("tail"), F.col("user_id").cast("string").alias("aircraft_id"), F.col("value").alias("lat"), F.col("value").alias("lon"),
        F.lit(1).alias("alt"), F.lit(2).alias("speed"), F.lit(3).alias("heading"), F.col("event_id").alias("_at"),
    )
    rows = _table(spark, sf_dir, "events").groupBy(F.floor(F.col("event_id") / 64).alias("clip")).agg(F.array_sort(F.collect_list(F.struct(F.col("event_id").alias("k"), point.alias("p")))).alias("ps"))
    return rows.select("clip", group_tracks(F.transform("ps", lambda x: x["p"].dropFields("_at"))).alias("tracks"))


@query()
def correction_prompts(spark, sf_dir):
    tails = F.array(F.concat(F.lit("N"), (F.col("conv_id") % 1000).cast("string")))
    return _heard(spark, sf_dir).select(
        "conv_id", "turn", F.sha2(correction_prompt(F.array("a", "b", "c"), F.col("a"), tails), 256).alias("prompt_sha256"), transcript_grammar(tails).alias("grammar")
    )


@query("""with r as (select *, row_number() over (partition by user_id order by event_id % 89, event_id) as n, count(*) over (partition by user_id) as attempts from events where event_type <> 'view')
select user_id, event_type || ':' || cast(value as varchar) as answer, attempts from r where n = 1""")
def effect_log_first_answer(spark, sf_dir):
    """A log of answers, a line an event, replayed: several attempts wrote answers to one key, the first counts."""
    log = _table(spark, sf_dir, "events").filter("event_type <> 'view'").select(
        F.lit(0).alias("shard"), F.col("user_id").alias("utterance_id"), F.concat_ws(":", "event_type", F.col("value").cast("string")).alias("answer"),
        (F.col("event_id") % 89).alias("at"), F.lit("").alias("file"), F.col("event_id").alias("pos"),
    )
    tried = log.groupBy("utterance_id").agg(F.count(F.lit(1)).alias("attempts"))
    return first_answers(log).join(tried, "utterance_id").select(F.col("utterance_id").alias("user_id"), "answer", "attempts")


@query()
def fuse_labels(spark, sf_dir):
    """The whole label stage over turns: vote, callsigns, agreement, clique, tier, confidence."""
    heard = _heard(spark, sf_dir).withColumn("utterance_id", F.concat_ws("/", F.col("conv_id").cast("string"), F.col("turn").cast("string")))
    tails = F.array(F.concat(F.lit("N"), (F.col("conv_id") % 1000).cast("string")))
    meta = heard.select("utterance_id", (F.col("conv_id") % 8).cast("int").alias("shard"), F.lit("kxyz").alias("airport"), tails.alias("tails"))
    each = F.array(*[F.struct(F.lit(m).alias("model"), F.col(m).alias("text"), F.lit(0.1).alias("no_speech")) for m in ("a", "b", "c")])
    hyps = heard.select("utterance_id", (F.col("conv_id") % 8).cast("int").alias("shard"), F.explode(each).alias("h")).select("utterance_id", "shard", "h.*")
    return fuse(meta, hyps, ["a", "b", "c"], [1.0, 1.0, 2.0], advisory="b")


@query()
def advisory_similarity(spark, sf_dir):
    return _heard(spark, sf_dir).select("conv_id", "turn", similarity(F.col("a"), F.col("b")).alias("similarity"))
