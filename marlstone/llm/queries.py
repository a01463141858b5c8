"""The queries of this subpackage and their SQL."""

from __future__ import annotations

from . import fim, quality, topk
from .bpe import op6_bpe
from .counts import op13_tokens
from .fim import op11_fim
from .linededup import op8_lines
from .lm import op4_hmm
from .packing import op1_packing
from .quality import op9_quality, quality_hosts
from .runs import op12_runs
from .simhash import op5_simhash
from .suffixarray import op3_suffix_array
from .suffixtree import op2_substrings
from .topk import op10_top_k
from .toxicity import op7_toxicity


def queries():
    return {f.__name__: f for f in (op1_packing, op2_substrings, op3_suffix_array, op4_hmm, op5_simhash, op6_bpe, op7_toxicity, op8_lines, op9_quality, op10_top_k, op11_fim, op12_runs, op13_tokens, quality_hosts)}


def oracle_sql() -> dict[str, str]:
    return {"op9_quality": quality.OP9_SQL, "op10_top_k": topk.OP10_SQL, "op11_fim": fim.OP11_SQL, "quality_hosts": quality.HOSTS_SQL}
