"""Operators for training-data pipelines, and a registered query for each."""

from __future__ import annotations

from rulspark.llm import balltree, streamdedup
from rulspark.llm.alignment import op13_pair_bitmaps
from rulspark.llm.balltree import op9_ball_trees
from rulspark.llm.bpe import op4_byte_bpe
from rulspark.llm.chat import op2_reply_trees
from rulspark.llm.langid import op7_cross_parsing
from rulspark.llm.ngram import op3_elias_fano_lm
from rulspark.llm.packing import op8_curve_packing
from rulspark.llm.quality import op5_fourier_quality
from rulspark.llm.repair import op12_repair_runs
from rulspark.llm.simhash import op10_simhash
from rulspark.llm.streamdedup import op11_stream_dedup
from rulspark.llm.toxicity import op6_subword_toxicity
from rulspark.llm.winnowing import op1_winnowing

QUERIES = {
    f.__name__: f
    for f in (
        op1_winnowing,
        op2_reply_trees,
        op3_elias_fano_lm,
        op4_byte_bpe,
        op5_fourier_quality,
        op6_subword_toxicity,
        op7_cross_parsing,
        op8_curve_packing,
        op9_ball_trees,
        op10_simhash,
        op11_stream_dedup,
        op12_repair_runs,
        op13_pair_bitmaps,
    )
}
ORACLES = {"op9_ball_trees": balltree.ORACLE, "op11_stream_dedup": streamdedup.ORACLE}
