"""The registered queries of the subpackage and their SQL."""

from __future__ import annotations

from jobsignal.llm import (
    ball_codes,
    embeddings,
    fill_middle,
    licenses,
    main_text,
    repetition,
    secrets,
    url_trust,
)
from jobsignal.llm.ball_codes import op11_ball_codes
from jobsignal.llm.byte_bpe import op10_byte_bpe
from jobsignal.llm.embeddings import op2_rotated_codes
from jobsignal.llm.fill_middle import op13_fill_middle
from jobsignal.llm.licenses import op3_license_scan
from jobsignal.llm.main_text import op12_main_text
from jobsignal.llm.mixing import op7_block_mixing
from jobsignal.llm.pii import op9_weak_pii
from jobsignal.llm.repetition import op4_suffix_repetition
from jobsignal.llm.secrets import op1_secret_scan
from jobsignal.llm.simhash import op8_simhash_groups
from jobsignal.llm.token_files import op5_token_files
from jobsignal.llm.url_trust import op6_host_trust

QUERIES = {f.__name__: f for f in (
    op1_secret_scan,
    op2_rotated_codes,
    op3_license_scan,
    op4_suffix_repetition,
    op5_token_files,
    op6_host_trust,
    op7_block_mixing,
    op8_simhash_groups,
    op9_weak_pii,
    op10_byte_bpe,
    op11_ball_codes,
    op12_main_text,
    op13_fill_middle,
)}
ORACLE_SQL: dict[str, str] = {
    "op1_secret_scan": secrets.SQL,
    "op2_rotated_codes": embeddings.SQL,
    "op3_license_scan": licenses.SQL,
    "op4_suffix_repetition": repetition.SQL,
    "op6_host_trust": url_trust.SQL,
    "op11_ball_codes": ball_codes.SQL,
    "op12_main_text": main_text.SQL,
    "op13_fill_middle": fill_middle.SQL,
}
