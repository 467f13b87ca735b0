"""The queries of this folder, and the SQL of those that SQL can express."""

from plantwatch.llm.chunks import op6_substrings
from plantwatch.llm.fingerprints import op4_fingerprints
from plantwatch.llm.fixity import OP2_SQL, op2_fixity
from plantwatch.llm.forest import op3_neighbours
from plantwatch.llm.jaccard import op8_jaccard
from plantwatch.llm.languages import op7_languages
from plantwatch.llm.licenses import op9_licenses
from plantwatch.llm.mixture import OP1_SQL, op1_mixture
from plantwatch.llm.packing import op10_packing
from plantwatch.llm.prefix_trie import OP12_SQL, op12_prefixes
from plantwatch.llm.secret_scan import op5_secrets
from plantwatch.llm.toxicity import op11_toxicity
from plantwatch.llm.whitening import op13_whitening

QUERIES = {
    fn.__name__: fn
    for fn in (
        op1_mixture, op2_fixity, op3_neighbours, op4_fingerprints, op5_secrets,
        op6_substrings, op7_languages, op8_jaccard, op9_licenses, op10_packing,
        op11_toxicity, op12_prefixes, op13_whitening,
    )
}
ORACLES = {"op1_mixture": OP1_SQL, "op2_fixity": OP2_SQL, "op12_prefixes": OP12_SQL}
