"""Registry of the corpus operators' queries."""

from __future__ import annotations

from lodestar.llm.ann import op1_nn_descent
from lodestar.llm.divergence import OP13_SQL, op13_perfect_hash_recount
from lodestar.llm.hilbert import op9_hilbert_shards
from lodestar.llm.mixing import op7_fair_queue_mix
from lodestar.llm.neardup import op3_weighted_minhash
from lodestar.llm.packing import op8_best_fit_pack
from lodestar.llm.periodic import op11_periodic_runs
from lodestar.llm.pii import op10_candidate_boosting
from lodestar.llm.quality import op2_decision_list
from lodestar.llm.secrets import op4_secret_ownership
from lodestar.llm.toxicity import op5_levenshtein_toxicity
from lodestar.llm.transducer import op6_transducer_counts
from lodestar.llm.urls import OP12_SQL, op12_bloom_cascade

QUERIES = {
    f.__name__: f
    for f in (
        op1_nn_descent,
        op2_decision_list,
        op3_weighted_minhash,
        op4_secret_ownership,
        op5_levenshtein_toxicity,
        op6_transducer_counts,
        op7_fair_queue_mix,
        op8_best_fit_pack,
        op9_hilbert_shards,
        op10_candidate_boosting,
        op11_periodic_runs,
        op12_bloom_cascade,
        op13_perfect_hash_recount,
    )
}

ORACLE_SQL: dict[str, str] = {"op12_bloom_cascade": OP12_SQL, "op13_perfect_hash_recount": OP13_SQL}
