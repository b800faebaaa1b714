"""Schemas of the tables that the stages read and write."""

from __future__ import annotations

SOURCE = (
    "utterance_id string, airport string, tails array<string>, audio struct<bytes:binary,path:string>, "
    "tracks array<struct<t:timestamp_ntz,tail:string,aircraft_id:string,lat:double,lon:double,alt:int,speed:int,heading:int>>, "
    "start timestamp_ntz, end timestamp_ntz, duration_s double, n_aircraft int, clip_offset_s double"
)
META = "utterance_id string, airport string, tails array<string>"
HYPS = "utterance_id string, text string, confidence double, no_speech double, nbest array<struct<text:string,score:double>>"
LABELS = (
    "utterance_id string, transcript string, tier string, confidence double, rover_confidence double, agreement_score double, "
    "n_models_agree long, n_tails long, callsign_matched boolean, callsign_tail string, callsign_score double, snapped boolean, "
    "voting_text array<string>, advisory_disagree double"
)
REVIEWS = (
    "utterance_id string, action string, seq long, ts double, shard int, reviewer string, decision string, transcript string, base_hyp string"
)
CORRECTED = f"{LABELS}, corrected boolean, callsign_enforced boolean"
WORK_LOG = "utterance_id string, transcript string, corrected boolean, callsign_enforced boolean"
PUBLISHED = (
    "utterance_id string, transcript string, confidence double, review_status string, agreement_score double, rover_confidence double, "
    "advisory_disagree double, n_models_agree long, callsign_matched boolean, callsign_tail string"
)
TRAINSET = "utterance_id string, transcript string, tier string, source string, reviewed boolean, agreement_score double, rover_confidence double"

#: Tiers, and what a review decision is published as.
TIERS = ("gold", "silver", "tail", "non_speech")
DECISIONS = ("accept", "edit", "reject", "non_speech")
REVIEW_STATUS = {"accept": "verified", "edit": "edited", "reject": "rejected", "non_speech": "non_speech"}
