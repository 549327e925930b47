"""Errors of the library; each keeps a context that its message shows."""

from __future__ import annotations


class NotewrightError(Exception):
    def __init__(self, message: str, **context):
        self.context = context
        super().__init__(message + (" [" + ", ".join(f"{k}={v}" for k, v in context.items()) + "]" if context else ""))


class ConfigurationError(NotewrightError): ...


class CodeError(NotewrightError): ...


class CodeNotFoundError(CodeError): ...


class InsufficientCodesError(CodeError): ...


class InvalidCodeFormatError(CodeError): ...


class GenerationError(NotewrightError): ...


class PromptError(GenerationError): ...


class TextGenerationError(GenerationError): ...


class RateLimitError(TextGenerationError):
    def __init__(self, message: str, retry_after: float | None = None, **context):
        self.retry_after = retry_after
        super().__init__(message, **context)


class ContentFilteredError(TextGenerationError): ...


class CallBudgetError(TextGenerationError): ...


class ValidationError(NotewrightError): ...


class RepositoryError(NotewrightError): ...


class DatasetLoadError(RepositoryError): ...
