"""The subscription-business models, composed of the operators."""
