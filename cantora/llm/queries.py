"""The registered queries of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from cantora.llm.chunked_media import op8_chunked_media
from cantora.llm.collision_search import op3_nearest
from cantora.llm.fixity import OP7_SQL, op7_warc_fixity
from cantora.llm.language_id import op2_language_id
from cantora.llm.mixing import OP10_SQL, op10_mixing
from cantora.llm.quality import op9_quality
from cantora.llm.secret_scan import op1_secret_scan
from cantora.llm.sentencepiece_codec import op6_sentencepiece
from cantora.llm.simhash import op5_simhash
from cantora.llm.url_filter import op4_url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_secret_scan, op2_language_id, op3_nearest, op4_url_filter, op5_simhash, op6_sentencepiece, op7_warc_fixity, op8_chunked_media, op9_quality, op10_mixing)
}

#: The others depend on trained models, seeded hashes or byte formats; their tests compare with brute force.
SQL: dict[str, str] = {"op7_warc_fixity": OP7_SQL, "op10_mixing": OP10_SQL}
