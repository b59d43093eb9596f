"""One hierarchy of errors."""


class PitchlineError(Exception):
    """Base of all."""


class DatasetNotFoundError(PitchlineError):
    pass


class InvalidDatasetError(PitchlineError):
    pass


class DataProcessingError(PitchlineError):
    pass


class SchemaMismatchError(PitchlineError):
    def __init__(self, missing):
        self.missing = list(missing)
        super().__init__(f"missing columns: {', '.join(self.missing)}")


class MissingColumnError(SchemaMismatchError):
    pass


class ValidationFailed(PitchlineError):
    """A check found rows that break it; check and count say which and how many."""

    def __init__(self, check: str, count: int, detail: str = ""):
        self.check, self.count = check, count
        super().__init__(f"{check}: {count} rows{' ' + detail if detail else ''}")


class InvalidDateError(ValidationFailed):
    pass


class InvalidScoreError(ValidationFailed):
    pass


class DuplicateMatchError(ValidationFailed):
    pass


class InvalidMatchError(PitchlineError):
    pass


class FeatureError(PitchlineError):
    pass


class SplittingError(PitchlineError):
    pass


class PreprocessingError(PitchlineError):
    pass


class EvaluationError(PitchlineError):
    pass


class NoModelsTrainedError(PitchlineError):
    pass


class FeatureMismatchError(PitchlineError):
    pass


class ModelLoadError(PitchlineError):
    pass
