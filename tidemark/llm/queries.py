"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from tidemark.llm.bpe import op13_transducer_bpe
from tidemark.llm.decontaminate import op3_simhash_decontaminate
from tidemark.llm.divergence import SQL as AUDIT_SQL
from tidemark.llm.divergence import op12_source_audit
from tidemark.llm.extract import op4_tag_path_ratio
from tidemark.llm.fingerprints import op1_threshold_sketch
from tidemark.llm.language import op2_string_kernel_language
from tidemark.llm.mixing import SQL as MIX_SQL
from tidemark.llm.mixing import op10_entropy_mix
from tidemark.llm.neardup import op5_order_minhash
from tidemark.llm.quality import op6_fourier_quality
from tidemark.llm.suffix import SQL as SUFFIX_SQL
from tidemark.llm.suffix import op9_difference_cover
from tidemark.llm.toxicity import op7_noisy_channel_toxicity
from tidemark.llm.trie import SQL as TRIE_SQL
from tidemark.llm.trie import op11_prefix_trie
from tidemark.llm.warc import SQL as WARC_SQL
from tidemark.llm.warc import op8_member_archives

QUERIES = {
    "op1_threshold_sketch": op1_threshold_sketch,
    "op2_string_kernel_language": op2_string_kernel_language,
    "op3_simhash_decontaminate": op3_simhash_decontaminate,
    "op4_tag_path_ratio": op4_tag_path_ratio,
    "op5_order_minhash": op5_order_minhash,
    "op6_fourier_quality": op6_fourier_quality,
    "op7_noisy_channel_toxicity": op7_noisy_channel_toxicity,
    "op8_member_archives": op8_member_archives,
    "op9_difference_cover": op9_difference_cover,
    "op10_entropy_mix": op10_entropy_mix,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_source_audit": op12_source_audit,
    "op13_transducer_bpe": op13_transducer_bpe,
}
SQL: dict[str, str] = {
    "op8_member_archives": WARC_SQL,
    "op9_difference_cover": SUFFIX_SQL,
    "op10_entropy_mix": MIX_SQL,
    "op11_prefix_trie": TRIE_SQL,
    "op12_source_audit": AUDIT_SQL,
}
