"""Ensemble labelling, review and publishing of short utterances as Spark DataFrame plans."""
