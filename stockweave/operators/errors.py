"""Argument errors a caller can show to a user."""


class RequestError(ValueError):
    def __init__(self, message: str, code: str = "invalid_request"):
        self.code = code
        self.message = message
        super().__init__(message)
