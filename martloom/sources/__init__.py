from martloom.sources.csv_files import (  # noqa: F401
    NA_TOKENS, infer_and_cast, nan_to_null, read_csv_by_name, read_full_csv, read_increment_csv,
    split_rejects,
)
from martloom.sources.landing import Landing, files_available  # noqa: F401
from martloom.sources.warehouse import Warehouse  # noqa: F401
