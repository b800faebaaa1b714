"""The stages of a run as DataFrame plans: transcribe, fuse, correct, effective labels."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ..functions.matching import match_callsign
from ..functions.text import canonical_callsigns, normalize, similarity
from ..functions.voting import rover
from ..operators.ensemble import agreement_score, classify_tier, clique_size, confidence_score, is_non_speech, pair_similarities
from ..operators.tables import join_voters, pending
from ..schemas import HYPS
from ..session import saved
from ..sinks.effects import EffectLog
from ..sinks.files import done_shards, write_stage
from ..sources.catalog import ModelSpec, check_weights, factory_of
from .calls import Calls, in_order, patient


def transcribe(clips: DataFrame, spec: ModelSpec, batch: int = 32) -> DataFrame:
    """utterance_id, text, confidence, no_speech, nbest, shard, model for each clip, and pos if clips have it.

    The model is made once a task. Within a task clips are ordered by length, so that a batch holds
    clips of like length; each result goes with its key, so no order has to be restored.
    """
    make, placed = factory_of(spec), "pos" in clips.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = make(spec)
        for rows in batches:
            for at in range(0, len(rows), batch):
                part = rows.iloc[at : at + batch]
                got = model.transcribe(part.to_dict("records"))
                yield pd.DataFrame({
                    "utterance_id": part["utterance_id"].to_numpy(), "text": [g["text"] for g in got],
                    "confidence": pd.array([g.get("confidence") for g in got], "Float64"), "no_speech": pd.array([g.get("no_speech") for g in got], "Float64"),
                    "nbest": [g.get("nbest") for g in got], "shard": part["shard"].to_numpy(), **({"pos": part["pos"].to_numpy()} if placed else {}),
                })

    ordered = clips.sortWithinPartitions("shard", F.size("audio.samples"))
    return ordered.mapInPandas(run, f"{HYPS}, shard int{', pos long' if placed else ''}").withColumn("model", F.lit(spec.name))


def run_transcriptions(clips: DataFrame, specs: Iterable[ModelSpec], folder: str, batch: int = 32, log: Callable[[str], None] = print) -> dict[str, str | None]:
    """Each model's hypotheses of the clips (with shard and pos), by model and shard in folder; {model: None, or what went wrong}.

    A model transcribes the shards that it has no output for, and none is made where it has all. A model that fails leaves no output and does not stop the
    others; a later run takes it up again.
    """
    spark, by, out = clips.sparkSession, ("model", "shard"), {}
    shards = saved(clips.select("shard").distinct())
    for spec in specs:
        asked = shards.withColumn("model", F.lit(spec.name))
        left = saved(pending(asked, done_shards(spark, folder, by), *by))
        if left.isEmpty():
            log(f"{spec.name}: all shards are there")
            out[spec.name] = None
            continue
        try:
            write_stage(transcribe(clips.join(F.broadcast(left.select("shard")), "shard", "left_semi"), spec, batch), folder, by)  # a number for each file
            out[spec.name] = None
        except Exception as e:
            out[spec.name] = str(e)
            log(f"{spec.name} failed: {e}")
    return out


def fuse(meta: DataFrame, hyps: DataFrame, voters: list[str], weights: list[float] | None = None, advisory: str | None = None, airlines: dict[str, str] | None = None, keys: tuple[str, ...] = ("shard", "utterance_id")) -> DataFrame:
    """Labels of the utterances that all voters have transcribed; columns of meta other than tails and airport come first.

    Normal forms, agreement, clique, tier and confidence are built-in functions. The vote and the
    callsign search are Arrow functions, each called once for a row.
    """
    given = check_weights(voters, weights)
    n = len(voters)
    rows = join_voters(meta, hyps, voters, advisory, keys)
    texts = F.transform("voting", lambda v: v["text"])
    vote = rover(texts, F.array(*[F.lit(float(w)) for w in given]))
    voted = rows.withColumn("_vote", vote).withColumn("_texts", texts)
    matched = voted.withColumn("_call", match_callsign(F.col("_vote.text"), F.col("tails"), airlines))
    pairs = pair_similarities([F.col("_texts")[i] for i in range(n)])
    named = {p: f"_s{p[0]}_{p[1]}" for p in pairs}
    compared = matched.select("*", *[c.alias(named[p]) for p, c in pairs.items()])
    cols = {p: F.col(c) for p, c in named.items()}
    score, agree = agreement_score(list(cols.values())), clique_size(cols, n)
    silent = is_non_speech(F.transform("_texts", normalize), F.transform("voting", lambda v: v["no_speech"]))
    none = F.size("tails") == 0
    disagree = F.when(F.col("advisory").isNotNull(), 1 - similarity(F.col("_vote.text"), F.col("advisory.text"))) if advisory else F.lit(None).cast("double")
    carried = [c for c in meta.columns if c not in ("tails", "airport", "utterance_id")]
    base = compared.select(
        *carried, "utterance_id", "_texts", "_call", "_vote", score.alias("agreement_score"), agree.cast("long").alias("n_models_agree"), silent.alias("_silent"),
        F.size("tails").cast("long").alias("n_tails"), (F.col("_call.matched") | none).alias("_ok"), disagree.alias("advisory_disagree"),
    )
    tier = classify_tier(F.col("_silent"), F.col("n_models_agree"), n, F.col("_ok"), F.col("agreement_score"))
    return base.withColumn("tier", tier).select(
        *carried, "utterance_id", F.when(F.col("tier") == "non_speech", "").otherwise(F.col("_call.text")).alias("transcript"), "tier",
        confidence_score(F.col("agreement_score"), F.col("_vote.confidence"), F.col("advisory_disagree")).alias("confidence"),
        F.col("_vote.confidence").alias("rover_confidence"), "agreement_score", "n_models_agree", "n_tails",
        F.col("_call.matched").alias("callsign_matched"), F.col("_call.tail").alias("callsign_tail"), F.col("_call.score").alias("callsign_score"),
        F.col("_call.snapped").alias("snapped"), F.col("_texts").alias("voting_text"), "advisory_disagree",
    )


#: The parts of a correction prompt, as the models were given them.
INSTRUCTION = (
    "You are correcting a single air traffic control radio transmission. Several speech recognizers produced the candidate transcripts below. "
    "They agree on most words and disagree on a few. Output one corrected transcript that keeps the agreed words and resolves the disagreements "
    "into fluent ATC phraseology. Write every number, callsign, and letter in spoken form, all lowercase, no punctuation. Output only the "
    "transcript on a single line."
)
DIRECTIVE = (
    "The only aircraft physically present are listed under CALLSIGNS, written in canonical spoken form. Any callsign you transcribe must be one "
    "of these exact spoken forms. Never invent a callsign that is not listed."
)


def correction_prompt(voting_text: Column, transcript: Column, tails: Column, instruction: str = INSTRUCTION, airlines: dict[str, str] | None = None) -> Column:
    """Instruction, callsigns (if there are any), numbered candidates, consensus, and the heading of the answer; a line each."""
    spoken = canonical_callsigns(tails, airlines)
    heading = F.array(F.lit(DIRECTIVE), F.lit(""), F.lit("CALLSIGNS"))
    calls = F.when(F.size(spoken) > 0, F.concat(heading, F.transform(spoken, lambda s: F.concat(F.lit("- "), s)))).otherwise(F.array().cast("array<string>"))
    listed = F.transform(F.coalesce(voting_text, F.array().cast("array<string>")), lambda t, i: F.concat_ws(". ", (i + 1).cast("string"), normalize(F.coalesce(t, F.lit("")))))
    lines = F.concat(
        F.array(F.lit(instruction)), calls, F.array(F.lit(""), F.lit("CANDIDATES")), listed,
        F.array(F.lit(""), F.lit("CONSENSUS"), normalize(transcript), F.lit(""), F.lit("CORRECTED")),
    )
    return F.array_join(lines, "\n")


def transcript_grammar(tails: Column, airlines: dict[str, str] | None = None) -> Column:
    """A grammar that holds the answer to the one callsign there is; null for none or several."""
    spoken = canonical_callsigns(tails, airlines)
    rules = ['root ::= (words " ")? callsign (" " words)?', 'callsign ::= "%s"', 'words ::= word (" " word)*', "word ::= [a-z]+", ""]
    return F.when(F.size(spoken) == 1, F.format_string("\n".join(rules), F.get(spoken, F.lit(0))))


Complete = Callable[[str, str | None], str]


def _prompted(silver: DataFrame, meta: DataFrame, airlines: dict[str, str] | None) -> DataFrame:
    """silver with _prompt and _grammar (null where the answer is free)."""
    about = meta.select(F.col("utterance_id").alias("_key"), F.col("tails").alias("_tails"))
    near = silver.join(about, silver["utterance_id"] == about["_key"], "left").drop("_key")
    tails = F.coalesce("_tails", F.array().cast("array<string>"))
    return near.select(
        *silver.columns, correction_prompt(F.col("voting_text"), F.col("transcript"), tails, airlines=airlines).alias("_prompt"),
        F.when(F.coalesce("callsign_matched", F.lit(False)), transcript_grammar(tails, airlines)).alias("_grammar"),
    )


def _settled(answered: DataFrame, columns: list[str], airlines: dict[str, str] | None) -> DataFrame:
    """columns, with the transcript that _answer gives, and corrected and callsign_enforced. A null answer changes nothing."""
    held = F.coalesce("callsign_matched", F.lit(False)) & F.col("callsign_tail").isNotNull()
    call = match_callsign(F.col("_answer"), F.when(held, F.array("callsign_tail")).otherwise(F.array().cast("array<string>")), airlines)
    found = answered.withColumn("_call", call)
    text = F.when(F.col("_call.text") != "", F.col("_call.text")).otherwise(normalize(F.col("transcript")))
    return found.select(
        *[c for c in columns if c != "transcript"], text.alias("_new"), (text != normalize(F.col("transcript"))).alias("corrected"),
        (held & F.col("_call.matched")).alias("callsign_enforced"),
    ).withColumnRenamed("_new", "transcript")


def _split(labels: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(silver rows, the others as they come out)."""
    silver = F.col("tier").eqNullSafe("silver")
    return labels.filter(silver), labels.filter(~silver).withColumns({"corrected": F.lit(False), "callsign_enforced": F.lit(False)})


def correct(
    labels: DataFrame, meta: DataFrame, complete: Callable[[], Complete], done: DataFrame | None = None, airlines: dict[str, str] | None = None, calls: Calls = Calls()
) -> DataFrame:
    """labels with transcript, corrected and callsign_enforced after asking a language model about the silver ones.

    complete makes, once a task, the function from (prompt, grammar or None) to an answer; calls.in_flight threads call it. Other
    tiers never reach it: they are split off before and united again. done has rows of earlier, broken runs
    (utterance_id, transcript, corrected, callsign_enforced): those are taken as they are and not asked again. run_corrections() keeps such a record itself.
    """
    silver, others = _split(labels)
    asked = silver if done is None else silver.join(done.select("utterance_id"), "utterance_id", "left_anti")

    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        ask = patient(complete(), calls)
        for prompts, grammars in batches:
            pairs = ((p, None if pd.isna(g) else g) for p, g in zip(prompts, grammars, strict=True))
            yield pd.Series(list(in_order(pairs, lambda pair: ask(*pair), calls.in_flight)), dtype=object)

    answer = F.pandas_udf(run, "string")(F.col("_prompt"), F.col("_grammar"))
    answered = saved(_prompted(asked, meta, airlines).withColumn("_answer", answer).drop("_prompt", "_grammar"))  # an answer is asked for once
    out = others.unionByName(_settled(answered, labels.columns, airlines))
    if done is not None:
        kept = silver.drop("transcript").join(done.select("utterance_id", "transcript", "corrected", "callsign_enforced"), "utterance_id")
        out = out.unionByName(kept)
    return out.select(*labels.columns, "corrected", "callsign_enforced")


def run_corrections(
    labels: DataFrame, meta: DataFrame, complete: Callable[[], Complete], folder: str, calls: Calls = Calls(), airlines: dict[str, str] | None = None,
    tasks: int | None = None, log: EffectLog | None = None,
) -> DataFrame:
    """Corrects the shards of labels (with shard and pos) that folder does not have, and writes them there; (shard, rows, corrected) of those.

    Each answer is written to a log as a task gets it, before anything else is done with it. A run that breaks leaves the log; the next one
    asks only what the log lacks, also for rows of tasks that Spark has tried again, so no prompt is asked twice once its answer is written down. What is put out is made
    from the log alone. Shards are promoted when all their answers are there, and then the log is removed. Rows without an answer (calls.on_failure is
    "none") keep their transcript.

    tasks spreads the prompts anew; without it they stay where the rows are. log is folder + ".answers" if none is given. The counts are observed as
    the rows are written, without a second scan.
    """
    spark, log = labels.sparkSession, log or EffectLog(f"{folder}.answers")
    left = pending(labels, done_shards(spark, folder))
    shards = left.count()
    none = spark.createDataFrame([], "shard int, rows long, corrected long")
    if not shards:
        log.clear(spark)
        return none
    silver, others = _split(labels.join(F.broadcast(left), "shard", "left_semi"))  # a number for each file
    prompted, key = _prompted(silver, meta, airlines), ["shard", "utterance_id"]
    asked = prompted.join(log.answers(spark).select(*key), key, "left_anti").select(*key, "_prompt", "_grammar")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ask, n = patient(complete(), calls), 0
        with log.writer() as writer:

            def one(row) -> None:
                answer = ask(row[2], None if pd.isna(row[3]) else row[3])
                if answer is not None:
                    writer.put(int(row[0]), row[1], answer)

            for _ in in_order((row for rows in batches for row in rows.itertuples(index=False, name=None)), one, calls.in_flight):
                n += 1
        yield pd.DataFrame({"n": [n]})

    (asked if tasks is None else asked.repartition(tasks)).mapInPandas(run, "n long").agg(F.sum("n")).collect()
    answers = log.answers(spark).withColumnRenamed("answer", "_answer")
    settled = _settled(prompted.join(answers, key, "left"), labels.columns, airlines)
    seen, bins = Observation(), max(shards, 2)  # with a bin for each shard a histogram counts exactly
    number = F.col("shard").cast("double")
    counts = {"rows": F.histogram_numeric(number, F.lit(bins)), "corrected": F.histogram_numeric(F.when(F.col("corrected"), number), F.lit(bins))}
    write_stage(others.unionByName(settled), folder, seen=seen, metrics=counts)
    log.clear(spark)
    corrected = {int(b["x"]): int(b["y"]) for b in seen.get["corrected"] or []}
    return spark.createDataFrame([(int(b["x"]), int(b["y"]), corrected.get(int(b["x"]), 0)) for b in seen.get["rows"] or []], none.schema)
