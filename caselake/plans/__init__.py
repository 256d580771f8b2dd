"""The layers and business questions, composed from the operators."""
