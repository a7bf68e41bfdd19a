"""kinnear: neighbourhood collaborative filtering as Spark DataFrame jobs.

Every operator takes and returns DataFrames. Long-form tables are used
throughout (one row per stored cell); nothing is gathered on the driver
except scalar parameters such as the user count.

Column conventions of the library:

    ratings      user bigint, item bigint, rating double
    means        user, mean
    deviations   user, item, dev
    profiles     user, item, weight        (non-zero weights only)
    similarities user, neighbour, sim
    neighbours   user, neighbour, sim, rank
    predictions  user, item, rating, prediction
"""

from kinnear.functions.expr import scale, safe_div, denormalise  # noqa: F401
from kinnear.operators.profile import (  # noqa: F401
    user_mean,
    item_mean,
    normalized_deviation,
    user_norm,
    unit_profile,
)
from kinnear.operators.similarity import (  # noqa: F401
    similarity_pairs,
    similarity_one_user,
    similarities,
)
from kinnear.operators.neighbours import (  # noqa: F401
    knn,
    rank_positives,
    rank_signed,
    neighbour_lists,
    explode_neighbours,
)
from kinnear.operators.predict import weighted_deviation, predict  # noqa: F401
from kinnear.operators.evaluate import (  # noqa: F401
    cell_errors,
    mae,
    error_stats_by_k,
    cold_start,
    sparse_difference,
)
