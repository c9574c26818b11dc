from quarry.functions import hashing, numbers, text  # noqa: F401
