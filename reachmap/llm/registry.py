"""The queries of this folder and the SQL for those that SQL can express."""

from .decontam import OP5_SQL, op5_decontamination
from .dedup import OP10_SQL, op10_exact_dedup
from .fingerprints import op11_fingerprints
from .hard_negatives import OP13_SQL, op13_hard_negatives
from .html_main import op2_html_main
from .langid import op4_language_id
from .mixing import OP8_SQL, op8_mixing
from .ngram_join import OP3_SQL, op3_ngram_join
from .pii import op7_pii
from .secrets import op6_secret_scan
from .sharding import op9_sharding
from .toxicity import op1_toxicity
from .whitening import op12_whitening

QUERIES = {
    f.__name__: f
    for f in (
        op1_toxicity,
        op2_html_main,
        op3_ngram_join,
        op4_language_id,
        op5_decontamination,
        op6_secret_scan,
        op7_pii,
        op8_mixing,
        op9_sharding,
        op10_exact_dedup,
        op11_fingerprints,
        op12_whitening,
        op13_hard_negatives,
    )
}
ORACLES = {
    "op3_ngram_join": OP3_SQL,
    "op5_decontamination": OP5_SQL,
    "op8_mixing": OP8_SQL,
    "op10_exact_dedup": OP10_SQL,
    "op13_hard_negatives": OP13_SQL,
}
