"""Queries of this subpackage, by name, and their SQL."""

from __future__ import annotations

from .decontaminate import OP7_SQL, op7_decontaminate
from .exact_dedup import OP9_SQL, op9_exact_dedup
from .language import op2_language
from .licenses import op5_licenses
from .lm_score import op1_lm_score
from .merkle import OP11_SQL, op11_merkle
from .mixing import op6_mixing
from .packing import op12_packing
from .pii import op10_pii
from .ranked import OP13_SQL, op13_ranked
from .sharding import op8_sharding
from .simhash import op4_simhash
from .toxicity import op3_toxicity

QUERIES = {f.__name__: f for f in (op1_lm_score, op2_language, op3_toxicity, op4_simhash, op5_licenses, op6_mixing, op7_decontaminate, op8_sharding, op9_exact_dedup, op10_pii, op11_merkle, op12_packing, op13_ranked)}
SQL = {"op7_decontaminate": OP7_SQL, "op9_exact_dedup": OP9_SQL, "op11_merkle": OP11_SQL, "op13_ranked": OP13_SQL}
