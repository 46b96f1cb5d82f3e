from siltworks.functions.casts import cast_text, clean, empty_to_null, parse, prepare

__all__ = ["cast_text", "clean", "empty_to_null", "parse", "prepare"]
