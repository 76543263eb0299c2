from .coin import hash_coin  # noqa: F401
from .exprs import (  # noqa: F401
    guarded_ratio, label_text, ordinal_encode, over_threshold, fixed4, squared_distance,
    vector_element, score_of,
)
