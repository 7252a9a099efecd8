"""Errors raised while a plan is built or a contract check runs."""


class ContractError(ValueError):
    """Input does not keep the response, label or vector contract."""


class EncoderConfigError(ValueError):
    """The encoder is set up wrongly; trying again cannot help."""
