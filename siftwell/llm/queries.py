"""The registered queries of the corpus operators and the SQL that some of them have."""

from siftwell.llm.divergence import OP13_SQL, op13_source_divergence
from siftwell.llm.fingerprint import op1_fingerprints
from siftwell.llm.language_id import op8_language_id
from siftwell.llm.licenses import OP12_SQL, op12_license_scan
from siftwell.llm.media import op4_media_columns
from siftwell.llm.merkle import OP11_SQL, op11_merkle_manifest
from siftwell.llm.packing import op2_packing
from siftwell.llm.piece_sampling import op9_piece_sampling
from siftwell.llm.secrets import op3_secrets
from siftwell.llm.simhash import op6_simhash
from siftwell.llm.suffix_dedup import op5_suffix_dedup
from siftwell.llm.toxicity import op7_toxicity
from siftwell.llm.url_filter import OP10_SQL, op10_url_filter

QUERIES = {
    "op1_fingerprints": op1_fingerprints,
    "op2_packing": op2_packing,
    "op3_secrets": op3_secrets,
    "op4_media_columns": op4_media_columns,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_simhash": op6_simhash,
    "op7_toxicity": op7_toxicity,
    "op8_language_id": op8_language_id,
    "op9_piece_sampling": op9_piece_sampling,
    "op10_url_filter": op10_url_filter,
    "op11_merkle_manifest": op11_merkle_manifest,
    "op12_license_scan": op12_license_scan,
    "op13_source_divergence": op13_source_divergence,
}
ORACLES = {"op10_url_filter": OP10_SQL, "op11_merkle_manifest": OP11_SQL, "op12_license_scan": OP12_SQL, "op13_source_divergence": OP13_SQL}
