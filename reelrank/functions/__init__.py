from reelrank.functions.columns import (clip, dot, hash_key, lenient_date, lenient_float,
                                        lenient_int, rmse, rounded)

__all__ = ["clip", "dot", "hash_key", "lenient_date", "lenient_float", "lenient_int",
           "rmse", "rounded"]
